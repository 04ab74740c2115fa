"""Mixing to target weights by iterative proportional fitting (DataFrame functions only).

Documents are summed into cells of (source, language, topic). Raking scales the
cells' token weights until every marginal agrees with its target or, where the
targets contradict each other, until sweeps bring them no nearer; what is left
between a marginal and its target is part of the result. The ratio of a cell's
weight to its tokens is the rate at which it should be represented.
Rates become probabilities ``min(1, c * ratio)``, with ``c`` calibrated so that
the expected number of sampled tokens is the wanted share of all tokens, and a
keyed draw per document decides.

Only cells are raked. Their number follows the distinct sources, languages and
topics, not the documents, and they stay a distributed table: every step is a
pre-aggregated sum and a join. What reaches the driver is one row a step.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.draws import hash60, key_text
from affinity.llm.common import stored, words

DIMENSIONS = ("source", "lang", "topic")
#: default targets: shares of tokens to this power, which lifts rare values and lowers common ones
TEMPER = 0.7
SAMPLE_SHARE = 0.7
#: raking ends when no share is off by more than TOLERANCE, or when PATIENCE sweeps take less than this part off the worst gap
TOLERANCE, PATIENCE, GAIN = 1e-3, 10, 1e-3
SEED = 10
#: grid points and rounds that calibrate the common factor
_GRID, _ROUNDS = 32, 4
#: stands for null in a cell's key
_NULL = "\x00"


def topic(text: Column) -> Column:
    """A coarse subject from plain signs in the text (a caller may pass any other expression)."""
    low = F.lower(F.coalesce(text, F.lit("")))
    size = F.length(low)
    return (F.when(low.contains("license") | low.contains("copyright") | low.contains("all rights reserved"), "legal")
            .when(low.contains("@"), "contact").when(low.contains(" | "), "table")
            .when(size < 400, "brief").when(size > 6000, "long").otherwise("prose"))


def _slim(docs: DataFrame, text_col: str, topic_of: Callable[[Column], Column]) -> list[Column]:
    keys = [F.coalesce(F.col(c).cast("string"), F.lit(_NULL)).alias(f"__{c}") for c in DIMENSIONS[:2]]
    return [*keys, F.coalesce(topic_of(F.col(text_col)), F.lit(_NULL)).alias("__topic")]


def _target(cells: DataFrame, dim: str, wanted: dict | None) -> DataFrame:
    """(dim, share): the wanted shares; values not named share the rest in proportion to their tokens."""
    own = cells.groupBy(dim).agg(F.sum("tokens").alias("tokens"))
    if wanted is None:
        own = own.select(dim, F.pow(F.col("tokens"), F.lit(TEMPER)).alias("raw"))
    else:
        named = F.create_map(*[F.lit(x) for k, v in wanted.items() for x in (_NULL if k is None else k, float(v))]) \
            if wanted else F.create_map().cast("map<string,double>")
        rest = F.lit(max(0.0, 1 - sum(wanted.values())))
        free = own.agg(F.sum(F.when(named[F.col(dim)].isNull(), F.col("tokens")))).first()[0] or 1.0
        own = own.select(dim, F.coalesce(named[F.col(dim)], rest * F.col("tokens") / F.lit(free)).alias("raw"))
    total = own.agg(F.sum("raw")).first()[0] or 1.0
    return own.select(dim, (F.col("raw") / F.lit(total)).alias("share"))


def _gaps(raked: DataFrame, goal: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Per dimension (value, has, share, gap): the share of every value and what it is off its target."""
    return {d: raked.groupBy(d).agg(F.sum("weight").alias("has")).join(goal[d], d).select(
        d, "has", "share", F.abs(F.col("has") - F.col("share")).alias("gap")) for d in DIMENSIONS}


def _goals(cells: DataFrame, targets: dict[str, dict | None] | None) -> dict[str, DataFrame]:
    return {d: stored(_target(cells, d, (targets or {}).get(d)), f"target-{d}") for d in DIMENSIONS}


def rake(cells: DataFrame, targets: dict[str, dict | None] | None = None, tolerance: float = TOLERANCE,
         patience: int = PATIENCE) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight`` and ``gap``.

    ``weight`` is the share of the mixture a cell should have. ``gap`` is how far
    the share of its source, language or topic still is from the target, the
    largest of the three. It is at most ``tolerance`` in every cell unless the
    targets contradict each other (a value that occurs in no cell with the
    others' wanted values): then sweeps end as soon as ``patience`` of them took
    less than ``GAIN`` off the worst gap, and the last sweep counts.
    """
    goal = _goals(cells, targets)
    total = cells.agg(F.sum("tokens")).first()[0] or 1.0
    now = cells.withColumn("weight", F.col("tokens") / F.lit(total))
    best: list[float] = []  # the smallest worst gap up to each sweep
    while True:
        for d in DIMENSIONS:
            factor = now.groupBy(d).agg(F.sum("weight").alias("has")).join(goal[d], d).select(
                d, F.when(F.col("has") > 0, F.col("share") / F.col("has")).otherwise(0.0).alias("factor"))
            now = now.join(factor, d).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
        now = stored(now, "raked")
        gaps = _gaps(now, goal)
        worst = reduce(DataFrame.union, [g.select("gap") for g in gaps.values()]).agg(F.max("gap")).first()[0]
        if worst is None or worst <= tolerance:
            break
        best.append(min([worst, *best[-1:]]))
        if len(best) > patience and not best[-1] <= (1 - GAIN) * best[-1 - patience]:  # a NaN ends it too
            break
    for d in DIMENSIONS:
        now = now.join(gaps[d].select(d, F.col("gap").alias(f"gap_{d}")), d)
    off = [f"gap_{d}" for d in DIMENSIONS]
    return now.withColumn("gap", F.greatest(*off)).drop(*off)


def marginals(raked: DataFrame, targets: dict[str, dict | None] | None = None) -> DataFrame:
    """(dimension, value, share, target, gap) of raked cells: what the mixture has of every value and what was wanted."""
    parts = [g.select(F.lit(d).alias("dimension"), F.when(F.col(d) != _NULL, F.col(d)).alias("value"),
                      F.col("has").alias("share"), F.col("share").alias("target"), "gap")
             for d, g in _gaps(raked, _goals(raked, targets)).items()]
    return reduce(DataFrame.union, parts)


def probabilities(raked: DataFrame, sample_share: float = SAMPLE_SHARE) -> DataFrame:
    """Adds ``ratio`` (weight per token share) and ``probability``, calibrated to the wanted share of tokens."""
    total = raked.agg(F.sum("tokens")).first()[0] or 1.0
    cells = stored(raked.withColumn("ratio", F.when(
        F.col("tokens") > 0, F.col("weight") * F.lit(total) / F.col("tokens")).otherwise(1.0)), "ratios")
    bounds = cells.where("ratio > 0 and tokens > 0").agg(F.min("ratio"), F.max("ratio"), F.sum("tokens")).first()
    factor = 1.0
    if bounds[0]:
        low, high, wanted = 0.0, 1.0 / bounds[0], sample_share * bounds[2]
        for _ in range(_ROUNDS):
            tries = [low + (high - low) * (i + 1) / _GRID for i in range(_GRID)]
            got = cells.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.lit(t) * F.col("ratio"))) for t in tries]).first()
            at = next((i for i, g in enumerate(got) if g >= wanted), _GRID - 1)
            low, high = (tries[at - 1] if at else low), tries[at]
        factor = high
    return cells.withColumn("probability", F.least(F.lit(1.0), F.lit(factor) * F.col("ratio")))


def cell_probabilities(slim: DataFrame, targets=None, sample_share: float = SAMPLE_SHARE) -> DataFrame:
    cells = stored(slim.groupBy(*[F.col(f"__{d}").alias(d) for d in DIMENSIONS]).agg(
        F.sum("n_tokens").cast("double").alias("tokens")), "cells")
    found = stored(probabilities(rake(cells, targets), sample_share), "probabilities")
    return found.select(*[F.col(d).alias(f"__cell_{d}") for d in DIMENSIONS],
                        F.col("ratio").alias("__ratio"), F.col("probability").alias("__probability"),
                        F.col("gap").alias("__gap"))


def _with_probability(rows: DataFrame, cells: DataFrame) -> DataFrame:
    cond = [rows[f"__{d}"] == cells[f"__cell_{d}"] for d in DIMENSIONS]
    return rows.join(cells, cond)


def _draw(id_col: str, seed: int) -> Column:
    return hash60(key_text(F.lit(seed), F.col(id_col))) / F.lit(float(1 << 60))


def mixture(docs: DataFrame, targets: dict[str, dict | None] | None = None, sample_share: float = SAMPLE_SHARE,
            id_col: str = "doc_id", text_col: str = "text", topic_of: Callable[[Column], Column] = topic,
            seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, lang, topic, n_tokens, weight, probability, sampled, gap.

    ``targets`` maps a dimension to wanted shares by value; a dimension left
    out takes its token shares to the power ``TEMPER``. ``weight`` is the
    factor by which the cell of a document is to be over- or under-represented,
    ``gap`` what raking left between its marginals and their targets (``rake``).
    n_tokens counts words. Null sources and languages are values of their own.
    Texts without words weigh nothing and take the probability of their cell;
    a cell without any words has ratio 1. Repeated ids share one draw. An
    empty table gives an empty result.
    """
    slim = stored(docs.select(F.col(id_col).alias("doc_id"), *_slim(docs, text_col, topic_of),
                              F.size(words(F.col(text_col))).cast("bigint").alias("n_tokens")), "mixing-rows")
    found = _with_probability(slim, cell_probabilities(slim, targets, sample_share))
    named = [F.when(F.col(f"__{d}") != _NULL, F.col(f"__{d}")).alias(d) for d in DIMENSIONS]
    return found.select("doc_id", *named, "n_tokens", F.col("__ratio").alias("weight"),
                        F.col("__probability").alias("probability"),
                        (_draw("doc_id", seed) < F.col("__probability")).alias("sampled"), F.col("__gap").alias("gap"))


def sample_mixture(docs: DataFrame, targets: dict[str, dict | None] | None = None, sample_share: float = SAMPLE_SHARE,
                   id_col: str = "doc_id", text_col: str = "text", topic_of: Callable[[Column], Column] = topic,
                   seed: int = SEED) -> DataFrame:
    """The sampled rows of ``docs``, all columns unchanged."""
    keys = _slim(docs, text_col, topic_of)
    slim = stored(docs.select(*keys, F.size(words(F.col(text_col))).cast("bigint").alias("n_tokens")), "mixing-rows")
    rows = docs.select(*docs.columns, *keys)
    found = _with_probability(rows, cell_probabilities(slim, targets, sample_share))
    return found.where(_draw(id_col, seed) < F.col("__probability")).select(*docs.columns)
