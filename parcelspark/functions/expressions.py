"""Business-rule column expressions (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
FACILITY_TYPES = ["National Hub", "Regional", "Local Branch"]
HUB_FACILITY_TYPES = ["National Hub", "Regional"]
WEIGHT_BRACKET_LIGHT = "Light (<5kg)"
WEIGHT_BRACKET_MEDIUM = "Medium (5-15kg)"
WEIGHT_BRACKET_HEAVY = "Heavy (>15kg)"
ROUTE_SEPARATOR = " -> "
FINANCIAL_EXCEPTION_TYPES = ["Lost", "Damaged"]
DELIVERED_STATUS = 50

MONEY_SUM_TYPE = "decimal(38,2)"


def weight_bracket(weight_kg: Column) -> Column:
    """Ordered thresholds; exactly 15.00 and NULL fall through to Heavy."""
    return (
        F.when(weight_kg < F.lit(5.0), F.lit(WEIGHT_BRACKET_LIGHT))
        .when(weight_kg < F.lit(15.0), F.lit(WEIGHT_BRACKET_MEDIUM))
        .otherwise(F.lit(WEIGHT_BRACKET_HEAVY))
    )


def on_time(actual_date: Column, estimated_date: Column) -> Column:
    """``CASE WHEN actual <= estimate THEN true ELSE false END`` (NULL -> false)."""
    return F.coalesce(actual_date <= estimated_date, F.lit(False))


def flag_to_int(flag: Column) -> Column:
    """``CASE WHEN b THEN 1 ELSE 0 END`` (NULL -> 0)."""
    return F.when(flag, F.lit(1)).otherwise(F.lit(0))


def route_label(origin_city: Column, destination_city: Column) -> Column:
    """NULL-propagating ``a || ' -> ' || b`` (``concat``, not ``concat_ws``)."""
    return F.concat(origin_city, F.lit(ROUTE_SEPARATOR), destination_city)


def money_sum(c: Column) -> Column:
    """``sum(decimal)`` widened to DECIMAL(38,2)."""
    return F.sum(c).cast(MONEY_SUM_TYPE)


def decimal_mean_as_double(c: Column) -> Column:
    """``avg(decimal)`` as DOUBLE: exact decimal sum, converted once, divided by count."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))
