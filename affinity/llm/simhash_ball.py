"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most 2 bits exactly if some third value
is within 1 bit of both. So every distinct fingerprint emits itself and its 64
one-bit variants, the shuffle is on the variants, and fingerprints that meet
are linked. A variant has at most 65 members by construction; each links to
the smallest of them (all are within 2 bits of each other), which keeps every
group connected without listing its pairs. Links are deduplicated and verified
by their bit count, then contracted to components.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import stored
from affinity.llm.components import connected_components

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
#: hashes turned into bits at a time, so that memory does not grow with a text
_CHUNK = 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def _words(text: str | None) -> list[bytes]:
    return _WORDS.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER)) if text else []


def _hashes(found: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """The hashes of all word shingles in order, _CHUNK at a time; fewer words are one shingle."""
    n = len(found)
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        if n:
            yield np.array([digest(joined, SEED)], "<u8")
        return
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    a, b = starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    for i in range(0, len(a), _CHUNK):
        part = a[i:i + _CHUNK]
        yield np.fromiter((digest(joined[x:y], SEED) for x, y in zip(part, b[i:i + _CHUNK])), "<u8", len(part))


def _simhash(found: list[bytes], shingle: int) -> int:
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in _hashes(found, shingle):
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash over word shingles (repeats included) as a signed 64-bit integer; no words: 0."""
    return _simhash(_words(text), shingle)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, also: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, fp) for every row of ``docs``, and its columns ``also``."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"), *(also or []))
    kept = rows.columns[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t.as_py(), shingle) for t in b.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], fp], [*kept, "fp"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(run, f"{kinds}, fp bigint")


def links(nodes: DataFrame) -> DataFrame:
    """Distinct, verified links (a, b), a > b, that connect all fingerprints within RADIUS bits."""
    flips = [F.lit(0)] + [F.lit((1 << i) - (1 << 64 if i == 63 else 0)) for i in range(BITS)]
    flips = F.array(*[x.cast("bigint") for x in flips])
    # spread first: the node table is small, its 65 variants are not
    ball = nodes.select("fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("variant"))
    met = ball.withColumn("low", F.min("fp").over(Window.partitionBy("variant"))).where("fp > low")
    pairs = met.select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable over links of at most
    RADIUS bits. Texts without words (null, empty, white space) have
    fingerprint zero and link like any other. Ids that repeat are separate
    rows; null ids are ignored by the minimum. Other columns are ignored. An
    empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "fingerprint-nodes")
    roots = connected_components(links(nodes), "a", "b")
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "low_id", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    classes = stored(rooted.join(lowest, "root").select(F.col("fp").alias("key"), "component_id"), "classes")
    return prints.join(classes, prints.fp == classes.key).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component; all columns unchanged.

    Components are those of ``simhash_components``. Of a component the row with
    the smallest id stays (null ids last; of rows that share the id, the one with
    the smallest SHA-256 of its text). Rows are told apart by id and text, so a
    repeated id with an unrelated text is a row of its own, and a row repeated
    with the same id and text stays once.
    """
    def content(text: Column) -> Column:
        return F.sha2(F.coalesce(text, F.lit("")), 256)

    rows = fingerprints(docs.withColumn(key := _free("content", docs), content(F.col(text_col))), id_col, text_col, shingle, [key])
    prints = stored(rows.withColumnRenamed(key, "content"), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")).alias("first")),
                   "fingerprint-nodes")
    roots = connected_components(links(nodes), "a", "b")
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("first", F.coalesce("root", "fp").alias("root"))
    stay = stored(rooted.groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("stay_id"), F.col("first.content").alias("stay_content")), "stay")
    tagged = docs.withColumn(key, content(F.col(text_col)))
    kept = tagged.join(stay.hint("merge"), tagged[id_col].eqNullSafe(stay.stay_id) & (tagged[key] == stay.stay_content), "left_semi")
    return kept.dropDuplicates([id_col, key]).select(*docs.columns)


def _free(name: str, df: DataFrame) -> str:
    """``name``, or a longer one that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name
