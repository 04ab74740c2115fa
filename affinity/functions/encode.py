"""Customer attribute encodings."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status codes; any other value, and a missing one, encodes as 0.
MEMBER_STATUS_CODES = {"ACTIVE": 1.0, "PRE-CREATE": 1.0, "LEFT CLUB": -1.0}
NEWS_FREQUENCY_CODES = {"NONE": -1.0, "Regularly": 1.0, "Monthly": 0.5}


def fill_missing(col: Column, value: float = -1.0) -> Column:
    """Missing -> sentinel."""
    return F.coalesce(col.cast("double"), F.lit(float(value)))


def map_codes(col: Column, codes: dict[str, float], default: float = 0.0) -> Column:
    """Value-map lookup with a default for null and unmapped values."""
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(float(v))) for k, v in codes.items()))
    return F.coalesce(F.element_at(lookup, col), F.lit(float(default)))


def encode_customers(customers: DataFrame) -> DataFrame:
    """Customers with FN / active_status filled and the two status columns coded as doubles."""
    return customers.select(
        "customer_id",
        fill_missing(F.col("FN")).alias("FN"),
        fill_missing(F.col("active_status")).alias("active_status"),
        map_codes(F.col("member_status"), MEMBER_STATUS_CODES).alias("member_status"),
        map_codes(F.col("news_frequency"), NEWS_FREQUENCY_CODES).alias("news_frequency"),
        F.col("age").cast("double").alias("age"),
        "postal_code",
    )
