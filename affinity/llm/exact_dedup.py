"""Exact duplicate removal with a heavy-hitter split (DataFrame functions only).

1. Every text becomes its SHA-256 digest; texts themselves are never shuffled.
2. Misra-Gries counters (``freqItems``) name at most ``1/support`` candidate
   digests. The list is bounded by the parameter, not by the data.
3. Candidates are counted exactly; those found more than once (the verified
   heavy groups with their winners) are broadcast and decided in the map tasks.
4. The remaining digests go through an ordinary shuffled aggregate and join.

A digest that the counters miss takes the ordinary path, so results never
depend on the sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import stored

#: a digest above this share of all rows is certain to be a candidate; its inverse bounds the broadcast
SUPPORT = 1 / 1024


def digest(text) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _group() -> list[Column]:
    return [F.sum("copies").alias("group_size"), F.max("doc_id").alias("keep_id")]


def _heavy(base: DataFrame, support: float) -> DataFrame:
    """(text_sha256, group_size, keep_id) of the verified heavy groups: 1 / support rows at most."""
    candidates = base.stat.freqItems(["text_sha256"], support).select(
        F.explode("text_sha256_freqItems").alias("text_sha256"))
    return stored(base.join(F.broadcast(candidates), "text_sha256").groupBy("text_sha256").agg(*_group())
                  .where("group_size > 1"), "heavy-winners")


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return stored(docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("text_sha256"))
                  .groupBy("doc_id", "text_sha256").agg(F.count("*").alias("copies")), "digests")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                support: float = SUPPORT) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, copies.

    Of equal texts (null counts as empty) the row with the largest id stays.
    Rows repeated with the same id and text are one document: they give one
    row, counted ``copies`` times in ``group_size``. A null id is smaller than
    any other. Other columns are ignored, whatever their names. An empty table
    gives an empty result.
    """
    base = _base(docs, id_col, text_col)
    heavy = _heavy(base, support)
    decided = base.join(F.broadcast(heavy), "text_sha256")
    rest = base.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    ordinary = rest.join(rest.groupBy("text_sha256").agg(*_group()), "text_sha256")
    cols = ["doc_id", "keep_id", "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "copies"]
    return decided.select(*cols).unionByName(ordinary.select(*cols))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged; repeated rows of a document stay once.

    Losers of heavy groups go in the map tasks. What is left is shuffled once
    by digest; as only the first row of a digest is asked for, every map task
    sends one row of a group at most.
    """
    heavy = _heavy(_base(docs, id_col, text_col), support).select(
        F.col("text_sha256").alias("__heavy_sha"), F.col("keep_id").alias("__heavy_keep"))
    tagged = docs.withColumn("__sha", digest(F.col(text_col)))
    light = tagged.join(F.broadcast(heavy), F.col("__sha") == F.col("__heavy_sha"), "left").where(
        F.col("__heavy_sha").isNull() | F.col(id_col).eqNullSafe(F.col("__heavy_keep")))
    first = Window.partitionBy("__sha").orderBy(F.col(id_col).desc_nulls_last())
    return light.withColumn("__rank", F.row_number().over(first)).where("__rank = 1").select(*docs.columns)
