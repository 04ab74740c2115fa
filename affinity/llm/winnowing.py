"""Document fingerprints by winnowing.

A text's fingerprint is the hashes of the k-grams that are the smallest of some
window of w successive ones, of equal ones the rightmost, with their positions.
Any passage of w + k - 1 code points that two texts share gives both a common
hash; equal texts have equal fingerprints.

``compare_with_edits`` needs every document beside the next one by falling id.
The ids are cut into ranges whose first rows (one per range) are known to all
tasks; a document goes to its range, and the first of a range also to the range
before it. Texts are shuffled once, and no task sees more than its ranges as a
stream.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: code points of a gram, grams of a window; together the length of a shared passage that is never missed
GRAM, WINDOW = 24, 41
GUARANTEE = GRAM + WINDOW - 1
#: ranges of ids for every shuffle partition, so that partitions even out
RANGES = 4
#: a key is a gram's 44-bit hash above its place counted from the end of a chunk: the smaller key is the rightmost of equal hashes
_PLACES = 20
_CHUNK = 1 << _PLACES
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_ROWS = 512


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base), _U)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hashes:
    """44-bit hashes of the grams of an array of code points; the powers are made once a process and length."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, _U)

    def __call__(self, codes: np.ndarray, gram: int) -> np.ndarray:
        n = len(codes)
        if len(self.up) <= n:
            self.up, self.down = _powers(_BASE, 2 * n + 2), _powers(pow(_BASE, -1, 1 << 64), 2 * n + 2)
        sums = np.zeros(n + 1, _U)
        np.cumsum((codes + _U(1)) * self.down[:n], out=sums[1:])
        h = (sums[gram:] - sums[:n + 1 - gram]) * self.up[gram - 1:n]
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            h = (h ^ (h >> _U(shift))) * _U(factor)
        return h >> _U(_PLACES)


_hashes = _Hashes()


def _smallest(keys: np.ndarray, window: int) -> np.ndarray:
    """The minimum of every window; the prefix and suffix minima of blocks of its length give each in one step."""
    n = len(keys)
    if n <= window:
        return keys.min(keepdims=True)
    blocks = np.full(-(-n // window) * window, ~_U(0))
    blocks[:n] = keys
    blocks = blocks.reshape(-1, window)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - window + 1], before[window - 1:n])


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Selected hashes and their positions (code points), in text order.

    A text shorter than a gram is one gram; null and empty texts have none.
    Work is done in overlapping chunks, so memory beyond the text is bounded.
    """
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gram = min(gram, len(codes))
    total = len(codes) - gram + 1
    hashes, places, at = [], [], 0
    while True:
        n = min(_CHUNK, total - at)
        h = _hashes(codes[at:at + n + gram - 1].astype(_U), gram)
        low = _smallest(h << _U(_PLACES) | np.arange(_CHUNK - 1, _CHUNK - 1 - n, -1, dtype=np.int64).astype(_U), window)
        low = low[np.concatenate(([True], low[1:] != low[:-1]))]
        place = (_CHUNK - 1 - (low & _U(_CHUNK - 1)).astype(np.int64)) + at
        again = int(bool(places) and place[0] == places[-1][-1])  # the chunk before has chosen it too
        hashes.append((low >> _U(_PLACES)).astype(np.int64)[again:])
        places.append(place[again:])
        if at + n == total:
            return np.concatenate(hashes), np.concatenate(places)
        at += n - window + 1


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints' sets of hashes; 1 if both are empty."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def as_text(hashes: np.ndarray) -> str:
    """11 lowercase hex digits for each hash, in text order."""
    digits = np.frombuffer(hashes.astype(">i8").tobytes().hex().encode(), "S1").reshape(-1, 16)
    return digits[:, 5:].tobytes().decode()


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, hashes, positions) for every row of ``docs``.

    Null and empty texts have empty lists. Repeated ids are separate rows;
    other columns are ignored. An empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, _ROWS):
                part = b.slice(i, _ROWS)
                found = [winnow(t.as_py(), gram, window) for t in part.column(1)]
                columns = [part.column(0), *(pa.array([f[k] for f in found], pa.list_(pa.int64())) for k in (0, 1))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hashes", "positions"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, hashes array<bigint>, positions array<bigint>")


def beside_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) dealt so that a document and its next one stream past one task.

    Columns doc_id, text, place (the range), guest: within a partition rows are
    sorted by place, then by falling doc_id (nulls last; equal ids by a hash of
    their texts); the guest after a range's last row is its next one.
    """
    order = ["no_id", "falling", "content"]
    rows = docs.select("doc_id", "text").withColumns({
        "no_id": F.col("doc_id").isNull(), "falling": F.bitwise_not(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0))),
        "content": F.xxhash64(F.coalesce("text", F.lit("")))})
    ranges = ranges or RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*order).repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
    # one row per range
    firsts = sorted(tuple(r.first) for r in dealt.groupBy("range").agg(F.min(F.struct(*order)).alias("first")).collect())

    @F.arrow_udf("array<int>")
    def places(no_id: pa.Array, falling: pa.Array, content: pa.Array) -> pa.Array:
        out = []
        for key in zip(no_id.to_pylist(), falling.to_pylist(), content.to_pylist()):
            at = bisect_right(firsts, key) - 1
            out.append([2 * at, 2 * ((at - 1) % len(firsts)) + 1] if firsts[at] == key else [2 * at])
        return pa.array(out, pa.list_(pa.int32()))

    spread = rows.withColumn("at", F.explode(places(*order)))
    spread = spread.withColumns({"place": F.shiftright("at", 1), "guest": F.col("at") % 2 == 1})
    return spread.repartition("place").sortWithinPartitions("place", "guest", *order).select("doc_id", "text", "place", "guest")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       gram: int = GRAM, window: int = WINDOW, ranges: int | None = None) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document.

    One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. The edited text has the last
    half of its code points (rounded down) replaced by the first as many of the
    next document. Next is by falling id, after the last the first. Null ids come
    last, equal ids ascend by a hash of their texts; a single document is its own
    next. Null texts are empty: no fingerprint, likeness 1 to each other and 0 to
    any other. Other columns are ignored. An empty table gives an empty result.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # a document that waits for its next one
        for b in batches:
            for i in range(0, b.num_rows, _ROWS):
                part, out, ids = b.slice(i, _ROWS), [], []
                for doc_id, text, guest in zip(part.column(0), part.column(1), part.column(3)):
                    text = text.as_py() or ""
                    own = winnow(text, gram, window)[0]
                    if held:
                        before, was, prints = held
                        half = len(was) // 2
                        edited = was[:len(was) - half] + text[:half]
                        changed = winnow(edited, gram, window)[0]
                        ids.append(before)
                        out.append((len(was), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_text(prints),
                                    as_text(changed), likeness(prints, changed), likeness(prints, own)))
                    held = None if guest.as_py() else (doc_id, text, own)
                if out:
                    columns = [pa.array([x.as_py() for x in ids], part.schema.field(0).type), *(pa.array(c) for c in zip(*out))]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return beside_next(rows, ranges).mapInArrow(
        run, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
