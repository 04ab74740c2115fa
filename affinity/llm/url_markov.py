"""URL filter: fixed rules first, else a character language-model ratio.

URLs that a rule decides are the accepted and rejected examples. For either
class a smoothed variable-order Markov model over the bytes of host and path
is counted over all examples: every order interpolates with the next shorter
one by how often its context was seen, so an unseen context falls back to the
longest seen one. The length-normalised difference of the two log likelihoods
is compared with a threshold calibrated on a held-out fold of the examples.

Counts are exact and stay in Spark tables: one row per distinct gram of every
order. Each level joins the next shorter one, and the urls' grams join the log
ratios of the longest. Nothing but the calibration's bins is collected.
``MarkovPair`` is the same model in hashed arrays of fixed size, for few urls
in one process; the query does not use it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import stored

#: (verdict, host, path prefix); the longest that fits decides
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ORDER = 5
SLOT_BITS = 15
TABLE = 1 << SLOT_BITS
#: weight of the shorter context's prediction, in observations
BACK_OFF = 4.0
#: log ratios are summed up as whole numbers of 1 / UNIT
UNIT = 10 ** 12
#: one example in so many calibrates the threshold instead of being counted
HELD_OUT = 5
#: scores are summed up in bins of 1 / BINS for the calibration
BINS, SCORE_LIMIT = 100, 8
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_U = np.uint64


def with_parts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path): the host lower-cased (A-Z); both empty without ``://`` or url."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return pages.select(F.col(id_col).alias("page_id"), rest.alias("__rest")).select(
        "page_id",
        F.translate(F.regexp_extract("__rest", r"^([^/?#]*)", 1), _UPPER, _UPPER.lower()).alias("host"),
        F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))


def matched(value: int, rules=RULES) -> Column:
    """The rule (0: its text, 1: its verdict) that decides a url, else null."""
    best = None
    for verdict, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        result = F.lit((host + path, verdict)[value])
        best = F.when(fits, result) if best is None else best.when(fits, result)
    return best if best is not None else F.lit(None).cast("string")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)


def _slots(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per byte of all urls: url index, slots of its grams and of their contexts (ORDER + 1 rows each)."""
    pad = b"\x00" * ORDER
    data = np.frombuffer(b"".join(pad + u for u in urls), np.uint8).astype(_U)
    size = np.array([len(u) for u in urls])
    owner = np.repeat(np.arange(len(urls)), size)
    at = np.arange(size.sum()) + ORDER * (owner + 1)
    context, grams, contexts = np.zeros(len(at), _U), [], []
    for k in range(ORDER + 1):
        if k:  # the context grows to the left
            context = (context * _U(0x9E3779B97F4A7C15)) + _mixed(data[at - k] + _U(1 + 256 * k))
        contexts.append((_mixed(context + _U(k)) >> _U(64 - SLOT_BITS)).astype(np.int64))
        grams.append((_mixed(context * _U(257) + _mixed(data[at] + _U(7919))) >> _U(64 - SLOT_BITS)).astype(np.int64))
    return owner, np.array(grams), np.array(contexts)


@dataclass
class MarkovPair:
    """Gram and context counts [class, order, slot] of both classes (0 rejected, 1 accepted)."""

    grams: np.ndarray
    contexts: np.ndarray
    threshold: float = 0.0

    def score(self, urls: list[bytes]) -> np.ndarray:
        """Mean log-likelihood difference per byte, accepted minus rejected; 0 for an empty url."""
        owner, grams, contexts = _slots(urls)
        total = np.zeros(len(urls))
        for c, sign in ((1, 1.0), (0, -1.0)):
            p = np.full(len(owner), 1 / 256)
            for k in range(ORDER + 1):
                p = (self.grams[c, k][grams[k]] + BACK_OFF * p) / (self.contexts[c, k][contexts[k]] + BACK_OFF)
            total += sign * np.bincount(owner, np.log(p), len(urls))
        return total / np.maximum(1, [len(u) for u in urls])


def _bytes(column: pa.Array) -> list[bytes]:
    return [x.as_py().encode("utf-8", "surrogatepass") for x in column]


def _grams(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per byte of all urls: url index, the byte and the ORDER bytes before it as one number."""
    pad = b"\x00" * ORDER
    data = np.frombuffer(b"".join(pad + u for u in urls), np.uint8).astype(np.int64)
    size = np.array([len(u) for u in urls], np.int64)
    owner = np.repeat(np.arange(len(urls)), size)
    at = np.arange(size.sum()) + ORDER * (owner + 1)
    return owner, sum((data[at - k] << (8 * k) for k in range(ORDER + 1)), np.zeros(len(at), np.int64))


def url_grams(urls: DataFrame) -> DataFrame:
    """(id, n_bytes, yes, no, gram, n) of every distinct gram of every row (id, yes, no, url)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _bytes(b.column(3))
            owner, gram = _grams(texts)
            order = np.lexsort((gram, owner))
            owner, gram = owner[order], gram[order]
            first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (gram[1:] != gram[:-1])][:len(owner)])
            rows = b.take(pa.array(owner[first]))
            size = np.array([len(t) for t in texts], np.int64)[owner[first]]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(size), rows.column(1), rows.column(2), pa.array(gram[first]),
                 pa.array(np.diff(np.r_[first, len(owner)]))], ["id", "n_bytes", "yes", "no", "gram", "n"])

    return urls.select("id", "yes", "no", "url").mapInArrow(
        run, "id bigint, n_bytes bigint, yes bigint, no bigint, gram bigint, n bigint")


def gram_ratios(grams: DataFrame) -> DataFrame:
    """(gram, ratio): log of accepted over rejected probability, in units of 1 / UNIT, of every distinct gram.

    A gram extends by one byte at most 256 ways, so no key of these joins and
    windows has more rows.
    """
    levels = [stored(grams.groupBy("gram").agg(F.sum(F.col("n") * F.col("yes")).alias("yes"),
                                               F.sum(F.col("n") * F.col("no")).alias("no")), "grams-longest")]
    for k in range(ORDER, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        levels.append(levels[-1].groupBy(shorter.alias("gram")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")))
    known = None
    for k, level in enumerate(reversed(levels)):
        context = Window.partitionBy(F.shiftright("gram", 8))
        level = level.withColumns({"all_yes": F.sum("yes").over(context), "all_no": F.sum("no").over(context)})
        if known is None:
            level = level.withColumns({"p_yes": F.lit(1 / 256), "p_no": F.lit(1 / 256)})
        else:
            level = level.join(known, level.gram.bitwiseAND(F.lit((1 << (8 * k)) - 1)) == known.ending).drop("ending")
        p = {c: (F.col(c) + BACK_OFF * F.col(f"p_{c}")) / (F.col(f"all_{c}") + BACK_OFF) for c in ("yes", "no")}
        known = level.select(F.col("gram").alias("ending"), p["yes"].alias("p_yes"), p["no"].alias("p_no"))
        if k < ORDER:
            known = stored(known, f"order-{k}")
    ratio = F.round((F.ln("p_yes") - F.ln("p_no")) * UNIT).cast("bigint")
    return stored(known.select("ending", ratio.alias("ratio")), "ratios")


def with_scores(parts: DataFrame) -> DataFrame:
    """``parts`` with a score: mean log-likelihood difference per byte, accepted minus rejected; 0 for an empty url.

    The examples are the rows with a label that are not held out.
    """
    counted = lambda v: F.count(F.when((F.col("label") == v) & (F.col("fold") != 0), 1))
    urls = parts.groupBy("url").agg(counted(1).alias("yes"), counted(0).alias("no"))
    urls = stored(urls.withColumn("id", F.monotonically_increasing_id()), "urls")
    grams = stored(url_grams(urls), "url-grams")
    ratios = gram_ratios(grams)
    # whole units, so that a sum does not depend on the order of its rows
    sums = grams.join(ratios, grams.gram == ratios.ending).groupBy("id").agg(
        (F.sum(F.col("n") * F.col("ratio")) / F.lit(UNIT) / F.max("n_bytes")).alias("sum"))
    scores = stored(urls.join(sums, "id").select(F.col("url").alias("of"), F.col("sum").alias("score")), "url-scores")
    return parts.join(scores, parts.url == scores.of, "left").drop("of").withColumn("score", F.coalesce("score", F.lit(0.0)))


def calibrate(scored: DataFrame) -> float:
    """The threshold with the best balanced accuracy on (label, score) rows, nearest zero of equals; 0 without both classes."""
    limit = SCORE_LIMIT * BINS
    bins = scored.select("label", F.greatest(F.lit(-limit), F.least(F.lit(limit), F.floor(F.col("score") * BINS)))
                         .cast("int").alias("bin")).groupBy("label", "bin").count().collect()  # 2 rows a bin at most
    count = np.zeros((2, 2 * limit + 1))
    for r in bins:
        count[r["label"], r["bin"] + limit] = r["count"]
    if not count.sum(axis=1).all():
        return 0.0
    below = np.concatenate((np.zeros((2, 1)), count.cumsum(axis=1)), axis=1)
    right = below[0] / below[0, -1] + 1 - below[1] / below[1, -1]
    best = np.flatnonzero(right >= right.max() - 1e-12) - limit
    return float(best[np.abs(best).argmin()]) / BINS


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score.

    A url without ``://`` (or null) has an empty host and path, fits no rule
    and scores 0. With examples of one class only, or none, the threshold is
    0. A score at the threshold is allowed. Repeated ids are separate rows;
    other columns are ignored. An empty table gives an empty result.
    """
    url = F.concat("host", "path")
    parts = stored(with_parts(pages, id_col, url_col).select(
        "*", matched(0, rules).alias("rule"), matched(1, rules).alias("said"), url.alias("url"),
        F.pmod(F.xxhash64(url), F.lit(HELD_OUT)).alias("fold")).withColumn("label", (F.col("said") == "allow").cast("int")), "url-parts")
    scored = stored(with_scores(parts), "scored-parts")
    threshold = calibrate(scored.where("rule is not null and fold = 0"))
    by_model = F.when(F.col("score") >= F.lit(threshold), "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("said", by_model).alias("verdict"), "score")
