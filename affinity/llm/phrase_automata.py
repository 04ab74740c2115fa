"""Substring dedup with repeated-phrase automata.

A window is WINDOW consecutive words. Windows that recur anywhere are found,
confirmed and removed as follows.

1. Anchors. Of every window the smallest hash of its GRAM-word grams is its
   anchor. Equal windows have equal anchors at the same place, so a window can
   only recur if its anchor does. Neighbouring windows share anchors: the
   windows of one anchor occurrence are a *region* of at most SPREAD windows.
   One pass over the texts gives a row of hashes per region and no text.
2. Candidates are the regions whose anchor occurs at least twice. Equal regions
   are counted, and one bearer of each is asked for its text, so copies are
   never moved more than once.
3. Confirmation. The windows of the distinct regions are counted with the
   regions' multiplicities by (anchor, window digest). Runs of windows that
   occur twice or more are the recurring passages.
4. Automata. Regions and their confirmed passages are dealt out in shards
   (anchor and region decide, so that a very common anchor is spread over all
   shards). Every shard compiles the passages of its regions into an
   Aho-Corasick automaton over words and streams the regions through it; every
   occurrence of a passage marks the windows that it covers. As a region's own
   passages are in its shard, no occurrence is missed.
5. The marks go back to all occurrences of a region, are gathered per document
   and joined with the texts, which lose the words of the marked windows.

Steps 1 and 3 aggregate before they shuffle and join on unique keys of one side,
so no group of copies meets in one task. Memory follows the Arrow batch and the
longest single text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import stored

WINDOW = 35
GRAM = 12
SPREAD = WINDOW - GRAM + 1
#: regions in an automaton; their distinct words have to be fewer than there are characters
SHARD = 10_000
#: bytes of text hashed at a time (one longer text is taken alone)
_PART = 1 << 20
_U = np.uint64
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd, so that powers have inverses modulo 2**64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: fixed random value per byte
_BYTE = np.random.default_rng(35).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U)
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        size = max(n + 1, 1 << 16)
        known = np.full(size, base & (2**64 - 1), _U)
        known[0] = 1
        known = np.cumprod(known, dtype=_U)
        if size <= 1 << 22:  # those for a very long text are not kept
            _powers[base] = known
    return known[:n + 1]


def _ranges(values: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of values[start:end] for many ranges, by prefix sums."""
    n = len(values)
    sums = np.concatenate((np.zeros(1, _U), np.cumsum(values * _power(base, n)[:n], dtype=_U)))
    back = _power(pow(base, -1, 2**64), n)
    return _mixed((sums[end] - sums[start]) * back[start] + (end - start).astype(_U))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def regions_of(data: np.ndarray, ends: np.ndarray):
    """(anchor, region, text index, first word, windows) of the texts data[:ends[0]], data[ends[0]:ends[1]], ...

    ``data`` holds UTF-8 bytes with one space after every text (inside ``ends``).
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int32, np.int32))
    word = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    n = len(start)
    if n < WINDOW:
        return none
    words = _ranges(_BYTE[data], _BASE, start, end)
    text = np.searchsorted(ends, start, side="right")
    at = np.arange(n)
    grams = _ranges(words, _STEP, at[:n - GRAM + 1], at[GRAM - 1:] + 1)
    # per window the first position of its smallest gram hash
    low = np.lib.stride_tricks.sliding_window_view(grams, SPREAD).argmin(axis=1) + at[:n - WINDOW + 1]
    ok = np.flatnonzero(text[:n - WINDOW + 1] == text[WINDOW - 1:])  # windows inside one text
    if not len(ok):
        return none
    first = np.flatnonzero(np.concatenate(([True], (np.diff(ok) != 1) | (np.diff(low[ok]) != 0)
                                           | (np.diff(text[ok]) != 0))))
    windows = np.diff(np.concatenate((first, [len(ok)])))
    begin = ok[first]
    anchor = low[begin]
    region = _ranges(words, _BASE, begin, begin + windows + WINDOW - 1) + _mixed((anchor - begin).astype(_U))
    first_word = np.searchsorted(text, np.arange(len(ends)))
    return (grams[anchor].view(np.int64), region.view(np.int64), text[begin],
            (begin - first_word[text[begin]]).astype(np.int32), windows.astype(np.int32))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, text): id and content hash name a row; rows equal in both are handled alike."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("row"), text.alias("text"))


def regions(rows: DataFrame) -> DataFrame:
    """Step 1: (doc_id, row, anchor, region, first, windows) for every region of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, size, begin = [], 0, 0
            for i, t in enumerate(b.column(2)):
                texts.append(t.as_py().encode("utf-8", "surrogatepass") + b" ")
                size += len(texts[-1])
                if size >= _PART or i == b.num_rows - 1:
                    anchor, region, text, first, windows = regions_of(
                        np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(x) for x in texts]))
                    own = pa.array(text + begin)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(own), b.column(1).take(own), pa.array(anchor), pa.array(region),
                         pa.array(first), pa.array(windows)], ["doc_id", "row", "anchor", "region", "first", "windows"])
                    texts, size, begin = [], 0, i + 1

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row bigint, anchor bigint, region bigint, first int, windows int")


def _same_row(a: DataFrame, b: DataFrame):
    return (a["row"] == b["at_row"]) & a["doc_id"].eqNullSafe(b["at_id"])


def _at(df: DataFrame, *cols) -> DataFrame:
    """Rows gathered per document; at most as many as a text has regions, however often its row is repeated."""
    return df.groupBy(F.col("row").alias("at_row"), F.col("doc_id").alias("at_id")).agg(
        F.collect_set(F.struct(*cols)).alias("parts"))


def region_texts(rows: DataFrame, bearers: DataFrame) -> DataFrame:
    """(anchor, region, times, text, digests): the words of each bearer region and a digest of each window."""
    asked = _at(bearers, "anchor", "region", "times", "first", "windows")
    named = rows.join(asked, _same_row(rows, asked)).select("text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for text, parts in zip(b.column(0), b.column(1)):
                words = _WORDS.findall(text.as_py().encode("utf-8", "surrogatepass"))
                for p in parts.as_py():
                    own = words[p["first"]:p["first"] + p["windows"] + WINDOW - 1]
                    joined = b" ".join(own)
                    ends = np.cumsum([len(w) + 1 for w in own]).tolist()
                    starts = [0, *ends]
                    hashes = [digest(joined[starts[k]:ends[k + WINDOW - 1] - 1]) for k in range(p["windows"])]
                    for column, value in zip(out, (p["anchor"], p["region"], p["times"], joined.decode("utf-8", "surrogatepass"),
                                                   np.array(hashes, _U).view(np.int64))):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)],
                                             ["anchor", "region", "times", "text", "digests"])

    return named.mapInArrow(run, "anchor bigint, region bigint, times bigint, text string, digests array<bigint>")


def confirmed(texts: DataFrame) -> DataFrame:
    """(anchor, region, mask): bit k is set if window k of the region occurs twice or more anywhere."""
    windows = texts.select("anchor", "region", "times", F.posexplode("digests").alias("k", "digest"))
    often = stored(windows.groupBy("anchor", "digest").agg(F.sum("times").alias("n")).where("n > 1")
                   .select(F.col("anchor").alias("often_anchor"), F.col("digest").alias("often_digest")), "often")
    found = windows.join(often, (windows.anchor == often.often_anchor) & (windows.digest == often.often_digest))
    return found.groupBy("anchor", "region").agg(F.bit_or(F.expr("shiftleft(1L, k)")).alias("mask"))


class _Code(dict):
    """One character per distinct word."""

    def __missing__(self, word: str) -> str:
        self[word] = char = chr(0x10000 + len(self))
        return char


def _runs(mask: int) -> Iterator[tuple[int, int]]:
    """(first, last) of the runs of set bits."""
    k = 0
    while mask >> k:
        if mask >> k & 1:
            j = k
            while mask >> (j + 1) & 1:
                j += 1
            yield k, j
            k = j
        k += 1


def locate(texts: DataFrame, passages: DataFrame) -> DataFrame:
    """Step 4: (anchor, region, mask) by automata over the confirmed passages of each shard."""
    p = passages.select(F.col("anchor").alias("p_anchor"), F.col("region").alias("p_region"), "mask")
    dealt = texts.join(p, (texts.anchor == p.p_anchor) & (texts.region == p.p_region)).select(
        "anchor", "region", "text", "mask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(i, SHARD) for whole in batches for i in range(0, whole.num_rows, SHARD)):
            code = _Code()
            streams = []
            automaton = ahocorasick.Automaton()
            for text, mask in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                # a word is one character here: passages begin and end at words
                stream = "".join(map(code.__getitem__, text.split(" ")))
                streams.append(stream)
                for first, last in _runs(mask):
                    automaton.add_word(stream[first:last + WINDOW], last - first + WINDOW)
            marks = []
            if len(automaton):
                automaton.make_automaton()
                for stream in streams:
                    mark = 0
                    for end, size in automaton.iter(stream):
                        mark |= ((1 << (size - WINDOW + 1)) - 1) << (end + 1 - size)
                    marks.append(mark)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(marks or [0] * b.num_rows, pa.int64())], ["anchor", "region", "mask"])

    return dealt.mapInArrow(run, "anchor bigint, region bigint, mask bigint").where("mask <> 0")


def recurring_spans(rows: DataFrame) -> DataFrame:
    """(at_row, at_id, parts): per document its (first, mask) marks; documents without any are left out."""
    found = stored(regions(rows), "regions")
    # unique sides are stored: a join that reads both sides from a shuffle can split a very common anchor
    twice = stored(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
                   .select(F.col("anchor").alias("twice")), "twice")
    candidates = stored(found.join(twice, found.anchor == twice.twice, "left_semi"), "candidates")
    bearers = candidates.groupBy("anchor", "region").agg(
        F.count("*").alias("times"), F.min(F.struct("row", "doc_id", "first", "windows")).alias("b")).select(
        "anchor", "region", "times", "b.*")
    texts = stored(region_texts(rows, bearers), "region-texts")
    passages = stored(confirmed(texts), "passages")
    marks = stored(locate(texts, passages).dropDuplicates(["anchor", "region"]), "marks").select(
        F.col("anchor").alias("m_anchor"), F.col("region").alias("m_region"), "mask")
    spans = candidates.join(marks, (candidates.anchor == marks.m_anchor) & (candidates.region == marks.m_region))
    return _at(spans, "first", "mask")


def remove_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and, if asked, kept and spans.

    ``spans`` are the removed word ranges [start, end). Words are judged on the
    input. A null text has no words; texts of fewer than WINDOW words lose
    nothing; rows repeated with the same id and text make each other's windows
    recur. Other columns are ignored. An empty table gives an empty result.
    """
    rows = _keyed(docs, id_col, text_col)
    spans = recurring_spans(rows)
    joined = rows.join(spans, _same_row(rows, spans), "left").select("doc_id", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept", "spans")}
            for text, parts in zip(b.column(1), b.column(2)):
                words = _WORDS.findall(text.as_py().encode("utf-8", "surrogatepass"))
                cuts: list[list[int]] = []
                for first, last in sorted((p["first"] + i, p["first"] + j + WINDOW)
                                          for p in parts.as_py() or () for i, j in _runs(p["mask"])):
                    if cuts and first <= cuts[-1][1]:
                        cuts[-1][1] = max(cuts[-1][1], last)
                    else:
                        cuts.append([first, last])
                left, at = [], 0
                for first, last in cuts:
                    left += words[at:first]
                    at = last
                left += words[at:]
                kept = b" ".join(left)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(left))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    out["kept"].append(kept.decode("utf-8", "surrogatepass"))
                    out["spans"].append([{"start": x, "end": y} for x, y in cuts])
            kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept": pa.string(),
                     "spans": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))}
            names = list(kinds)[:5 if with_text else 3]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(out[k], kinds[k]) for k in names]], ["doc_id", *names])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_removed bigint, kept_sha256 string"
    return joined.mapInArrow(run, schema + ", kept string, spans array<struct<start:int,end:int>>" * with_text)
