"""Historical weather CSV (header row) from an object store or any Hadoop path.

``s3a_conf`` returns the Hadoop settings for an S3-compatible endpoint; the
read itself is the plain CSV source with the declared schema (``date`` as
DATE, ``True``/``False`` text as BOOLEAN).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark import schemas
from parcelspark.sources.fs import path_exists

WEATHER_OBJECT = "historical_weather_delays.csv"


class SourceMissingError(RuntimeError):
    """The configured bucket / object does not exist (seed it first)."""


def s3a_conf(endpoint: str, access_key: str, secret_key: str, ssl: bool = False) -> dict[str, str]:
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def object_path(bucket_uri: str, object_name: str = WEATHER_OBJECT) -> str:
    return f"{bucket_uri.rstrip('/')}/{object_name}"


def read_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        raise SourceMissingError(f"weather source {path} does not exist; seed the bucket first")
    return (
        spark.read.schema(schemas.WEATHER)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_weather_csv(weather: DataFrame, path: str) -> None:
    """Write in the producer's text form (header, ``True``/``False`` flags)."""
    (
        weather.select(
            F.date_format("date", "yyyy-MM-dd").alias("date"),
            "city",
            "weather_condition",
            "precipitation_mm",
            F.when(F.col("regional_delay_flag"), F.lit("True"))
            .when(~F.col("regional_delay_flag"), F.lit("False"))
            .alias("regional_delay_flag"),
        )
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
