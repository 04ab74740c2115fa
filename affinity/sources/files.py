"""Typed CSV scans with the reference's missing-value rules.

The reference reads CSV text with a reader that maps a fixed set of tokens
(``NA``, ``None``, ``nan``, ...) to missing and parses numbers that may be
NaN. Here every column is read as text with a declared all-string schema,
tokens become NULL, and the text is ``try_cast`` to the declared type, so a
malformed value becomes NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

import csv
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.sources import schemas
from affinity.sources.csv_ranges import csv_records


def normalise_missing(col: Column, dtype: T.DataType) -> Column:
    """Missing tokens to NULL, then a lenient cast; NaN doubles become NULL too."""
    text = F.when(~col.isin(schemas.NULL_TOKENS), col)
    typed = text.try_cast(dtype)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        typed = F.nanvl(typed, F.lit(None).cast(dtype))
    return typed


#: quotes are doubled inside quoted text
_FORMAT = {"quote": '"', "escape": '"', "emptyValue": ""}


def _csv(spark: SparkSession, line_breaks: bool = True):
    return spark.read.options(**_FORMAT).option("header", True).option("multiLine", line_breaks).option("inferSchema", False)


def quoted_line_breaks(spark: SparkSession, files: list[str]) -> bool:
    """Whether some line has an odd number of quotes, as the lines of a record with a line break in quotes do.

    Without one, every line is a record and Spark cuts the files into ranges of
    lines. Otherwise `csv_ranges` puts the records together.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return bool(spark.read.text(files).where(quotes % 2 == 1).take(1))


def file_headers(spark: SparkSession, files: list[str]) -> list[tuple[str, ...]]:
    """The column names in the first line of every file; opens them one after another and reads a line of each."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    found = []
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream, codec = path.getFileSystem(conf).open(path), codecs.getCodec(path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        found.append(tuple(next(csv.reader([line.removeprefix("\ufeff")]))) if line else ())
    return found


def read_csv_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` as text, taken by their names in each file's own header.

    Quotes are doubled inside quoted text, and quoted text may hold commas and
    line breaks. Files of a folder may order their columns differently: those
    with the same header are read together, in ranges of lines, also where line
    breaks are quoted. Only files whose quotes follow no rule (`csv_records`) are
    read whole, by one task each. Columns beyond the schema are left
    out; a missing one, in any file, is an error. Empty files have no rows.
    """
    orders: dict[tuple[str, ...], list[str]] = {}
    names = sorted(_csv(spark).csv(path).inputFiles())
    for name, header in zip(names, file_headers(spark, names)):
        orders.setdefault(header, []).append(name)
    orders.pop((), None)
    if not orders:
        raise ValueError(f"{path}: no file with a header")
    parts = []
    for header, files in orders.items():
        missing = [f.name for f in schema.fields if f.name not in header]
        if missing:
            raise ValueError(f"{files[0]}: no column {', '.join(missing)} in {list(header)}")
        breaks = quoted_line_breaks(spark, files)
        records = csv_records(spark, files) if breaks else None
        if records is None:
            raw = _csv(spark, breaks).csv(files)
        else:
            fields = T.StructType([T.StructField(name, T.StringType()) for name in header])
            raw = records.select(F.from_csv("record", fields.toDDL(), {**_FORMAT, "multiLine": "true"}).alias("r")).select("r.*")
        parts.append(raw.select([F.col(f"`{f.name}`").cast("string").alias(f.name) for f in schema.fields]))
    return functools.reduce(DataFrame.unionByName, parts)


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Typed columns; with ``strict`` any value that is neither missing nor of its type is an error."""
    text = read_csv_text(spark, path, schema)
    if strict:
        bad = {k: n for k, n in bad_values(text, schema).first().asDict().items() if n}
        if bad:
            raise ValueError(f"{path}: values that don't fit their type, by column: {bad}")
    return text.select([normalise_missing(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def bad_values(text: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per column, how many texts are neither a missing token nor a value of its type."""
    return text.agg(*[F.count(F.when(~F.col(f.name).isin(schemas.NULL_TOKENS) & F.col(f.name).try_cast(f.dataType).isNull(), 1))
                      .alias(f.name) for f in schema.fields])


def read_customers(spark: SparkSession, path: str, schema: T.StructType = schemas.CUSTOMERS) -> DataFrame:
    return read_typed_csv(spark, path, schema)


def read_products(spark: SparkSession, path: str, schema: T.StructType = schemas.PRODUCTS) -> DataFrame:
    return read_typed_csv(spark, path, schema)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, schemas.TRANSACTIONS)


def read_label_lists(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Dated label lists (``[1 2 3]`` text), tagged with their split name."""
    return read_typed_csv(spark, path, schemas.LABEL_LISTS).withColumn("split", F.lit(split))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, schemas.REQUESTS)
