"""Quality rules with adaptive thresholds (DataFrame functions only).

Fixed cut-offs are replaced by what is usual in a document's language and
source. Every metric is kept per group in a log-linear histogram: bins of
whole numbers, exact below 32 and within 1/16 of the value above. Such a
sketch is merged by adding counts, so sources merge into their language and
languages into the whole, and a sketch has a bounded number of bins however
many rows it sums up. A sketch gives the quartiles and the mean distance from the
median, which is above zero also where most values are equal. A fence lies REACH
times the sum of quartile distance and mean distance, and a bin, above the upper
(for word length also below the lower) quartile. A group's figures are blended with its
language's and these with the whole's: WEIGHT rows' worth of the wider ones are
added, so that a small group leans on its language and no size switches. The
fences join back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import SPACES, bound, stored, words

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: words of a repeated window; fewest words; most repeated words in percent
REPEAT, FEWEST_WORDS, MOST_REPEATED = 5, 10, 20
#: per thousand characters of words: symbols, capitals, exclamation marks; per thousand lines: repeated
#: ones after the first; tenths of characters a word
METRICS = ("symbols", "capitals", "shouts", "dup_lines", "word_len")
#: metrics with a lower fence as well
TWO_SIDED = ("word_len",)
#: distances between a quartile and its fence; rows of the wider group added to a group's own
REACH, WEIGHT = 3, 10
_NULL = "\x00"


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeated_words(w: Column) -> Column:
    """Words inside windows of REPEAT words that occur twice or more."""
    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        def same(s: Column) -> Column:
            twice = F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
                             | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)))
            places = F.sort_array(F.transform(twice, lambda e: e["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(-REPEAT).alias("last"))
            return F.aggregate(places, start, lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(REPEAT), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bound(pairs, same))

    places = F.when(F.size(w) >= REPEAT, F.sequence(F.lit(0), F.size(w) - REPEAT)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(REPEAT)]))
    return bound(hashes, covered)


def document_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source") -> DataFrame:
    """Per row: doc_id, __lang, __source, the base counts and the metrics (whole numbers, per thousand or tenths)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: _without(x, SPACES) != "")
    by_words = bound(words(F.col(text_col)), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"), _repeated_words(w).cast("bigint").alias("n_repeat_words")))
    by_lines = bound(lines, lambda x: F.struct(
        F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")))
    count = lambda chars: (F.length(text) - F.length(_without(text, chars))).cast("bigint")
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit(_NULL)).alias("__lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit(_NULL)).alias("__source"),
        by_words.alias("w"), F.length(_without(text, SPACES)).cast("bigint").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"), count(CAPITALS).alias("n_capitals"), count("!").alias("n_shouts"), by_lines.alias("l"))
    flat = base.select("doc_id", "__lang", "__source", "w.*", "word_chars", "n_symbols", "n_capitals", "n_shouts", "l.*")
    share = lambda part, whole: F.expr(f"{part} * 1000 div greatest({whole}, 1)")
    return flat.withColumns({
        "symbols": share("n_symbols", "word_chars"), "capitals": share("n_capitals", "word_chars"),
        "shouts": share("n_shouts", "word_chars"), "dup_lines": share("greatest(n_dup_lines - 1, 0)", "n_lines"),
        "word_len": F.expr("word_chars * 10 div greatest(n_words, 1)"),
        "base_failed": (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))})


def bin_top(value: str) -> Column:
    """The largest whole number in the bin of ``value``: itself below 32, else 16 bins per power of two."""
    drop = f"(length(bin({value})) - 5)"
    return F.expr(f"CASE WHEN {value} < 32 THEN {value} "
                  f"ELSE shiftleft(shiftright({value}, {drop}) + 1, {drop}) - 1 END")


def sketches(metrics: DataFrame) -> DataFrame:
    """(__lang, __source, metric, top, n): the histogram of every metric in every group."""
    tall = metrics.select("__lang", "__source", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), bin_top(m).alias("top")) for m in METRICS])).alias("e"))
    return tall.groupBy("__lang", "__source", "e.metric", "e.top").agg(F.count("*").alias("n"))


def _figures(sketch: DataFrame, keys: list[str], level: str) -> DataFrame:
    """(keys, metric, n, q1, q3 and away of the level) of the sketches merged to ``keys``."""
    merged = sketch.groupBy(*keys, "metric", "top").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")  # a row per bin: bounded by the bins of a sketch
    run = merged.withColumns({"so_far": F.sum("n").over(group.orderBy("top")), "all": F.sum("n").over(group)})
    run = run.withColumn("middle", F.min(F.when(F.col("so_far") * 2 >= F.col("all"), F.col("top"))).over(group))
    quartile = lambda k: F.min(F.when(F.col("so_far") * 4 >= F.col("all") * k, F.col("top"))).cast("double")
    return run.groupBy(*keys, "metric").agg(
        F.max("all").cast("double").alias(f"n_{level}"), quartile(1).alias(f"q1_{level}"), quartile(3).alias(f"q3_{level}"),
        (F.sum(F.col("n") * F.abs(F.col("top") - F.col("middle"))).cast("double") / F.max("all").cast("double")).alias(f"away_{level}"))


def fences(sketch: DataFrame, weight: int = WEIGHT, reach: int = REACH) -> DataFrame:
    """One row per group: f_lang, f_source, upper (and lower) fence of every metric."""
    own = _figures(sketch, ["__lang", "__source"], "own")
    lang = _figures(sketch, ["__lang"], "lang")
    whole = _figures(sketch, [], "whole")
    every = own.join(lang, ["__lang", "metric"]).join(whole, "metric")

    def blended(figure: str) -> Column:
        added = F.lit(float(weight))
        wide = (F.col("n_lang") * F.col(f"{figure}_lang") + added * F.col(f"{figure}_whole")) / (F.col("n_lang") + added)
        return ((F.col("n_own") * F.col(f"{figure}_own") + added * wide) / (F.col("n_own") + added)).alias(figure)

    chosen = every.select("__lang", "__source", "metric", *[blended(x) for x in ("q1", "q3", "away")])
    far = F.lit(float(reach)) * (F.col("q3") - F.col("q1") + F.col("away"))
    def fence(m: str, low: bool) -> Column:
        bin_of = lambda q: F.lit(1.0) + F.col(q) / F.lit(16.0)
        side = F.col("q1") - far - bin_of("q1") if low else F.col("q3") + far + bin_of("q3")
        return F.max(F.when(F.col("metric") == m, side)).alias(f"{'low' if low else 'top'}_{m}")
    return chosen.groupBy(F.col("__lang").alias("f_lang"), F.col("__source").alias("f_source")).agg(
        *[fence(m, False) for m in METRICS], *[fence(m, True) for m in TWO_SIDED])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", weight: int = WEIGHT, reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, the metrics, base_failed, kept.

    ``kept`` is false if ``base_failed``, else whether every metric lies within
    the fences of the document's language and source. Null texts have no words
    (and so fail the base rules); null languages and sources are groups of
    their own. Repeated ids are separate rows; other columns are ignored. An
    empty table gives an empty result.
    """
    metrics = stored(document_metrics(docs, id_col, text_col, lang_col, source_col), "metrics")
    limits = stored(fences(stored(sketches(metrics), "sketches"), weight, reach), "fences")
    judged = metrics.join(limits, (metrics["__lang"] == limits.f_lang) & (metrics["__source"] == limits.f_source))
    within = F.lit(True)
    for m in METRICS:
        within = within & (F.col(m) <= F.col(f"top_{m}"))
    for m in TWO_SIDED:
        within = within & (bin_top(m) >= F.col(f"low_{m}"))  # quartiles are tops of bins, too
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *METRICS,
                         "base_failed", (~F.col("base_failed") & within).alias("kept"))
