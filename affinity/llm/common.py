"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import checkpoint_dir

#: ASCII white space as the query contracts define it
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: removes a job's shuffle files when it ends
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: later stages re-read the files, so a lost executor costs a
    re-read and not a recomputation of everything before.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")  # the table replaces this job's shuffle files
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used inside a lambda may otherwise be inlined into it and computed
    again for every element.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null gives an empty array."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.filter(F.split(flat, " +"), lambda w: w != "")

