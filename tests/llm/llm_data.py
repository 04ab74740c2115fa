"""Rows that every operator has to take, and the table they come in."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: null, empty, white space only, repeated, very long and odd texts; null and repeated ids
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "one"), (None, "two words"), (None, None),
       (6, "Überraschung ἀρχή Σίσυφος 中文 😀 \x00   end"), (7, "x" * 200_000), (8, "word " * 60_000), (9, "a b c\na b c\na b c")]

LONG, STR = T.LongType(), T.StringType()
DOCS = T.StructType([T.StructField("doc_id", LONG), T.StructField("text", STR), T.StructField("lang", STR),
                     T.StructField("source", STR), T.StructField("n_chars", LONG)])
#: names that operators use inside, as columns of the caller
EXTRA = ("row", "anchor", "fp", "n_tokens", "text_sha256", "content", "score", "weight", "kept", "rule")


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents table from (doc_id, text[, lang, source]) rows, with clashing extra columns."""
    def make(rows, extra=True):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "src0")), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        return df.withColumns({n: F.lit("extra") for n in EXTRA}) if extra else df
    return make
