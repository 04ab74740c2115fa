"""Records of CSV files with quoted line breaks, cut out by many tasks.

Whether a line break ends a record depends on the quotes before it: it does
where their number is even. A task that starts in the middle of a file doesn't
know that number, but needs only its parity. So

1. the files are scanned as lines in ranges, and every line is tagged with its
   place in its range, the parity of the quotes before it in the range, and where
   the record around it began for either parity at the start of the range;
2. the ranges of a file (a row each) get the parity at their start by a running
   sum, and where a record that runs into them began;
3. a line that is a record by itself goes on as it is; the others are grouped by
   where their record began.

The tagged lines are written once: how a file is cut into ranges depends on the
executors at hand, and both later steps have to see the same ranges. So are the
records, which are looked over before they are read as columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.session import stored

_TAGGED = "file string, block bigint, seq bigint, before int, odd int, first0 bigint, first1 bigint, value string"
#: a record in which quotes stand around whole fields or are doubled, nowhere else
_STRICT = r'(?s)^(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)(?:,(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+))*+$'


def _tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, seq, parity, first = None, 0, 0, [-1, -1]
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        file, block, value = b.columns
        odd = pc.count_substring(value, '"').to_numpy() & 1
        moved = np.diff(block.to_numpy()) != 0
        if n > 1:
            moved |= pc.not_equal(file.slice(1), file.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(moved) + 1).tolist(), n]
        tags: list[list[np.ndarray]] = [[], [], [], []]
        for lo, hi in zip(edges, edges[1:]):
            here = (file[lo].as_py(), block[lo].as_py())
            if here != key:
                key, seq, parity, first = here, 0, 0, [-1, -1]
            after = (parity + np.cumsum(odd[lo:hi])) & 1
            before = after ^ odd[lo:hi]
            at = seq + np.arange(hi - lo)
            begun = [np.maximum(np.maximum.accumulate(np.where(before == k, at, -1)), first[k]) for k in (0, 1)]
            seq, parity, first = seq + hi - lo, int(after[-1]), [int(x[-1]) for x in begun]
            for tag, part in zip(tags, (at, before, *begun)):
                tag.append(part)
        at, before, first0, first1 = map(np.concatenate, tags)
        yield pa.RecordBatch.from_arrays(
            [file, block, pa.array(at, pa.int64()), pa.array(before, pa.int32()), pa.array(odd, pa.int32()),
             pa.array(first0, pa.int64()), pa.array(first1, pa.int64()), value],
            ["file", "block", "seq", "before", "odd", "first0", "first1", "value"])


def _entered(lines: DataFrame) -> DataFrame:
    """(file, block, from_block, from_seq) of every range that starts inside a record, and where that began."""
    ranges = lines.groupBy("file", "block").agg(
        F.sum("odd").alias("flips"), F.max(F.when(F.col("before") == 0, F.col("seq"))).alias("last0"),
        F.max(F.when(F.col("before") == 1, F.col("seq"))).alias("last1"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    known = ranges.withColumn("inside", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    known = known.withColumn("open", F.when(begun.isNotNull(), F.struct(F.col("block").alias("from_block"), begun.alias("from_seq"))))
    return known.withColumn("open", F.last("open", ignorenulls=True).over(earlier)).where("inside = 1").select(
        "file", "block", "open.*")


def csv_records(spark: SparkSession, files: list[str]) -> DataFrame | None:
    """(record): the text of every record but the files' headers, or None if ranges can't tell the records apart.

    That is so where quotes stand inside unquoted fields or a file ends inside
    quotes, and where a carriage return is not part of a line's end. Lines end
    in a line feed, with or without a carriage return; empty lines are skipped.
    """
    scan = spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    lines = stored(scan.mapInArrow(_tag, _TAGGED), "csv-lines")
    if lines.where(F.col("value").rlike("(?s)\\r.")).take(1):
        return None
    placed = lines.join(_entered(lines), ["file", "block"], "left")
    entered = F.col("from_block").isNotNull()
    carried = entered & (F.col("first1") == -1)
    placed = placed.select(
        "file", "block", "seq", "value",
        ((F.col("before") == entered.cast("int")) & (F.col("odd") == 0)).alias("alone"),
        F.when(carried, F.col("from_block")).otherwise(F.col("block")).alias("at_block"),
        F.when(carried, F.col("from_seq")).when(entered, F.col("first1")).otherwise(F.col("first0")).alias("at_seq"))
    parts = F.sort_array(F.collect_list(F.struct("block", "seq", "value")))
    joined = placed.where("NOT alone").groupBy("file", "at_block", "at_seq").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    whole = placed.where("alone").select("value", "at_block", "at_seq").unionByName(joined.drop("file"))
    records = stored(whole.where("at_block > 0 OR at_seq > 0").select(
        F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")).alias("record")
    ).where("record <> ''"), "csv-records")
    return None if records.where(~F.col("record").rlike(_STRICT)).take(1) else records
