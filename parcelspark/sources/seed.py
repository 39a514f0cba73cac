"""Status-code reference mapping (the seed)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelspark import schemas

# The seed table, in its natural order
# (status_code, status_name, is_final_state, is_exception).
STATUS_CODE_ROWS = [
    (10, "Label Created", False, False),
    (20, "Picked Up", False, False),
    (30, "Arrived At Hub", False, False),
    (35, "Departed Hub", False, False),
    (40, "Out For Delivery", False, False),
    (50, "Delivered", True, False),
    (60, "Delivery Failed", False, True),
    (70, "Damaged", True, True),
    (80, "Lost", True, True),
]


def status_codes(spark: SparkSession) -> DataFrame:
    """The seed as a tiny local relation (9 rows: always safe to broadcast)."""
    return spark.createDataFrame(STATUS_CODE_ROWS, schemas.STATUS_CODES)


def read_status_codes_csv(spark: SparkSession, path: str) -> DataFrame:
    """Load the seed from its CSV form (header row, ``true``/``false`` flags)."""
    return (
        spark.read.schema(schemas.STATUS_CODES)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
