"""Spelling variants by search schemes on bidirectional FM-indexes.

One edit leaves one half of a word as it is. So every word of the vocabulary is
searched twice: its left half is matched exactly and extended to the right with
one error, and its right half exactly and extended to the left. An index covers
a range of the sorted vocabulary (for right halves: of the reversed words, and
the search is the mirrored one) and a word visits the indexes whose range its
half falls into. The vocabulary, the indexes and the pairs found stay
distributed; the driver holds one word per range.

An index is built over the delimited text ``$w1$w2...$wN`` read as a ring. A
state is a pair of suffix-rank intervals, of a string in the text and of its
reverse in the reversed text, kept in step, so that it grows at either end. The
interval of ``$word$`` is the word's rank. All queries of a block move together
as arrays.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import stored

#: code points and occurrences that a word has at least; how many times as frequent its form is
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: a run whose checksum this divides loses a code point
DAMAGE = 31
#: words of an index at most (but for the spread of Spark's range partitions)
INDEX_WORDS = 4096
_QUERIES = 1024
_DISTINCT = 1 << 17
_LETTERS = "A-Za-zÀ-ÿ"
_LOWER = {c: c + 32 for c in range(65, 91)}


def text_words(doc_id: int | None, text: str | None, min_length: int = MIN_LENGTH) -> Counter:
    """The words of one document with their counts, runs damaged by their checksum; a null id reads as empty."""
    out: Counter = Counter()
    runs = Counter(r.translate(_LOWER) for r in re.findall(f"[{_LETTERS}]{{{min_length},}}", text or ""))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % DAMAGE == 0:
            run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) < min_length:
                continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """Stored (word, n): words of at least ``min_length`` code points with ``min_count`` occurrences overall."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                seen.update(text_words(doc_id.as_py(), text.as_py(), min_length))
                if len(seen) > _DISTINCT:
                    yield _counts(seen)
                    seen.clear()
        yield _counts(seen)

    rows = docs.select(id_col, text_col).mapInArrow(run, "word string, n bigint")
    return stored(rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "vocabulary")


def _counts(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])


class _Half:
    """One direction: the ring's rotations in order, as the letters before them."""

    def __init__(self, ring: np.ndarray, letters: int):
        n = len(ring)
        rank, width = ring.astype(np.int64), 1
        while True:
            pair = rank * (n + letters) + np.roll(rank, -width)
            order = np.argsort(pair, kind="stable")
            changed = np.concatenate(([0], np.cumsum(np.diff(pair[order]) != 0)))
            rank = np.empty(n, np.int64)
            rank[order] = changed
            if changed[-1] == n - 1 or width >= n:
                break
            width *= 2
        before = ring[order - 1]
        #: occ[i, c]: rotations among the first i with letter c before them; below[i, c]: with a letter smaller than c
        self.occ = np.zeros((n + 1, letters + 1), np.int32)
        self.occ[np.arange(1, n + 1), before] = 1
        np.cumsum(self.occ, axis=0, out=self.occ)
        self.below = np.cumsum(self.occ, axis=1, dtype=np.int32) - self.occ
        self.first = self.below[n].astype(np.int64)

    def grow(self, lo: np.ndarray, other: np.ndarray, size: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
        """Put letter ``c`` before: the interval here, the start of its partner, and their size."""
        hi = lo + size
        low = self.occ[lo, c]
        return (self.first[c] + low, other + self.below[hi, c] - self.below[lo, c], (self.occ[hi, c] - low).astype(np.int64))


class Index:
    """Bidirectional FM-index over distinct words; letter 0 is the delimiter, the last one any unknown letter."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        joined = np.frombuffer("".join(self.words).encode("utf-32-le"), "<u4")
        self.alphabet = np.unique(joined)
        self.unknown = len(self.alphabet) + 1
        lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        ring = np.zeros(len(joined) + len(self.words), np.int64)
        ring[np.arange(len(joined)) + np.repeat(np.arange(1, len(self.words) + 1), lengths)] = np.searchsorted(self.alphabet, joined) + 1
        self.forward, self.backward = _Half(ring, self.unknown), _Half(ring[::-1], self.unknown)
        self.n = len(ring)

    def _codes(self, queries: list[str]) -> np.ndarray:
        """Letters of the queries, a row each, filled up with delimiters."""
        width = max(map(len, queries)) + 1
        points = np.zeros((len(queries), width), np.uint32)
        for row, q in zip(points, queries):
            row[:len(q)] = np.frombuffer(q.encode("utf-32-le"), "<u4")
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(points == 0, 0, np.where(self.alphabet[at] == points, at + 1, self.unknown))

    def one_error_behind(self, queries: list[str], halves: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of words that begin with a query's first ``half`` letters and differ from it by one edit behind them."""
        codes = self._codes(queries)
        half, length = np.array(halves, np.int64), np.array([len(q) for q in queries], np.int64)
        q = np.arange(len(queries))
        lo, ro, size = np.zeros_like(q), np.zeros_like(q), np.full_like(q, self.n)
        for k in range(int(half.max()) + 1):  # the half backwards, then the delimiter before it
            go = q[(k <= half[q]) & (size[q] > 0)]
            c = np.where(k < half[go], codes[go, np.maximum(half[go] - 1 - k, 0)], 0)
            lo[go], ro[go], size[go] = self.forward.grow(lo[go], ro[go], size[go], c)
        right = self.backward.grow
        exact = tuple(x[size > 0] for x in (q, lo, ro, size))  # no error so far
        wrong = tuple(x[:0] for x in exact)  # with its error
        found = []
        for i in range(int((length - half).max()) + 1):
            at = half[exact[0]] + i
            exact = tuple(x[at <= length[exact[0]]] for x in exact)
            e, elo, ero, esize = exact
            at, letter = half[e] + i, codes[e, half[e] + i]
            inside = at < length[e]
            # any letter but the delimiter that follows in the index: one more than the query has, or another one
            rows, c = np.nonzero(self.backward.occ[ero + esize, 1:] > self.backward.occ[ero, 1:])
            c = c + 1
            bro, blo, bsize = right(ero[rows], elo[rows], esize[rows], c)
            more = (e[rows], blo, bro, bsize)
            other = inside[rows] & (c != letter[rows])
            ahead = [tuple(x[other] for x in more), tuple(x[inside] for x in exact)]  # replaced; missing in the word
            w, wlo, wro, wsize = (np.concatenate(x) for x in zip(wrong, more))
            at = half[w] + i
            wro, wlo, wsize = right(wro, wlo, wsize, codes[w, at])
            done = (at == length[w]) & (wsize > 0)
            found.append((w[done], wlo[done]))
            go = (at < length[w]) & (wsize > 0)
            wrong = tuple(np.concatenate(x) for x in zip((w[go], wlo[go], wro[go], wsize[go]), *ahead))
            e, elo, ero, esize, letter = (x[inside] for x in (*exact, letter))
            ero, elo, esize = right(ero, elo, esize, letter)
            exact = tuple(x[esize > 0] for x in (e, elo, ero, esize))
        pairs = np.unique(np.concatenate([a * len(self.words) + b for a, b in found]))
        return pairs // len(self.words), pairs % len(self.words)


def _starts(vocab: DataFrame, key, ranges: int) -> list[str]:
    """The first key of every range of the sorted vocabulary, one word per range."""
    dealt = vocab.select(key.alias("key")).repartitionByRange(ranges, "key").withColumn("range", F.spark_partition_id())
    return sorted(r.key for r in dealt.groupBy("range").agg(F.min("key").alias("key")).collect())


def near_pairs(vocab: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """Rows (word, n, near, near_n): every ordered pair of words of ``vocab`` that differ by exactly one edit, once.

    ``vocab`` is a stored table of distinct words and their counts.
    """
    ranges = max(-(-vocab.count() // index_words), int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    starts = [_starts(vocab, key, ranges) for key in (F.col("word"), F.reverse("word"))]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A word goes into the index of its range, and as a query to all ranges that hold words with its half."""
        for b in batches:
            out = []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for mirrored, first in enumerate(starts):
                    read = word[::-1] if mirrored else word
                    half = read[:len(word) - len(word) // 2 if mirrored else len(word) // 2]
                    own = bisect_right(first, read) - 1
                    out.append((2 * own + mirrored, False, word, n))
                    for x in range(max(bisect_right(first, half) - 1, 0), bisect_left(first, half + "\U0010FFFF")):
                        out.append((2 * x + mirrored, True, word, n))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["place", "asks", "word", "n"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by place, the index's words before the queries."""
        place, index, counts, asking = None, None, {}, []

        def answers() -> pa.RecordBatch:
            mirrored, out = place % 2, []
            reads = [w[::-1] if mirrored else w for w, _ in asking]
            halves = [len(w) - len(w) // 2 if mirrored else len(w) // 2 for w in reads]
            for a, b in zip(*(x.tolist() for x in index.one_error_behind(reads, halves))):
                (word, n), near = asking[a], index.words[b]
                if mirrored:
                    near = near[::-1]
                    if near.startswith(word[:len(word) // 2]):
                        continue  # the left half's search has it
                out.append((word, n, near, counts[near]))
            asking.clear()
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else ((),) * 4, kinds)], ["word", "n", "near", "near_n"])

        for b in batches:
            for now, asks, word, n in zip(*(c.to_pylist() for c in b.columns)):
                if now != place:
                    if asking:
                        yield answers()
                    place, index, counts = now, None, {}
                if not asks:
                    counts[word] = n
                    continue
                if index is None:
                    index = Index([w[::-1] for w in counts] if place % 2 else list(counts))
                asking.append((word, n))
                if len(asking) == _QUERIES:
                    yield answers()
        if asking:
            yield answers()

    dealt = vocab.select("word", "n").mapInArrow(deal, "place bigint, asks boolean, word string, n bigint")
    return dealt.repartition("place").sortWithinPartitions("place", "asks", "word").mapInArrow(
        search, "word string, n bigint, near string, near_n bigint")


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO,
                   min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, index_words: int = INDEX_WORDS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are what ``vocabulary`` finds in the texts (null and empty texts have
    none; every row counts, repeated ones too). A word's form is its most
    frequent near word (ties: the smallest in code-point order) if that is at
    least ``ratio`` times as frequent; root follows forms to the last, each more
    frequent than the one before. Other columns are ignored. A table without
    words gives an empty result.
    """
    vocab = vocabulary(docs, id_col, text_col, min_length, min_count)
    best = near_pairs(vocab, index_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best = best.select(F.col("word").alias("of"), "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    fits = F.col("near_n") >= ratio * F.col("n")
    words = stored(vocab.join(best, F.col("word") == F.col("of"), "left").select(
        "word", F.when(fits, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, F.col("near_n")).alias("form_n")), "words")
    roots = stored(words.where("form is not null").select(F.col("word").alias("below"), F.col("form").alias("root")), "roots")
    while True:  # every round doubles the steps; counts grow tenfold a step, so there are few
        onward = roots.select(F.col("below").alias("step"), F.col("root").alias("next"))
        roots = stored(roots.join(onward, F.col("root") == F.col("step"), "left").select(
            "below", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not roots.where("moved").limit(1).count():
            break
        roots = roots.drop("moved")
    return words.join(roots, F.col("word") == F.col("below"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
