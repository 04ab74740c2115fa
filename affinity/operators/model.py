"""Scorers: the fixed affinity scorer (M2b) and the boosted-tree pipeline.

Affinity scorer
---------------
A logistic model with written-down weights, expressed as Spark Columns:

    logit = c(customer) + g(product) + max_k w_k * match_k
    c = intercept + frequency_weight * ln(1 + total_purchases)
    g = popularity_weight * ln(1 + popularity)

with w_k >= 0. Each term is rounded to 9 decimals, so that any engine that
evaluates the same expression ranks pairs identically. Because the pair term
is a maximum of non-negative per-attribute bonuses, the best products of a
customer can be found exactly without scoring every product (see
``recommend``).

Boosted trees
-------------
``GBTClassifier`` in a ``Pipeline`` with a ``StringIndexer`` for the one
text feature and day numbers for dates; missing numeric values are replaced
by a sentinel far outside every feature's range.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.pairs import FAVOURITES
from affinity.operators.pairs import MODEL_FEATURES
from affinity.sources.schemas import LABEL_COL

DECIMALS = 9


def _default_match_weights() -> dict[str, float]:
    # attribute -> bonus for matching the customer's favourite value
    return {
        "department_no": 1.2, "sec_no": 1.1, "prod_type_no": 0.9, "garment_group_no": 0.9,
        "colour_group_code": 0.8, "perceived_colour_value_id": 0.7, "graph_appearance_no": 0.6,
        "prod_group_name": 0.6, "idx_code": 0.5, "perceived_colour_master_id": 0.4, "idx_group_no": 0.3,
    }


@dataclass(frozen=True)
class AffinityScorer:
    intercept: float = -3.5
    frequency_weight: float = 0.3
    popularity_weight: float = 0.4
    match_weights: dict = field(default_factory=_default_match_weights)

    def __post_init__(self):
        if any(w < 0 for w in self.match_weights.values()):
            raise ValueError("match weights must be non-negative")

    def customer_term(self, total_purchases: Column) -> Column:
        return F.round(F.lit(self.intercept) + F.lit(self.frequency_weight)
                       * F.log(F.lit(1.0) + F.coalesce(total_purchases.cast("double"), F.lit(0.0))), DECIMALS)

    def product_term(self, popularity: Column) -> Column:
        return F.round(F.lit(self.popularity_weight)
                       * F.log(F.lit(1.0) + F.coalesce(popularity.cast("double"), F.lit(0.0))), DECIMALS)

    def match_bonus(self, matches: dict[str, Column]) -> Column:
        """max_k w_k * match_k (0 when nothing matches); ``matches`` maps attribute -> boolean Column.

        Written as the weight of the first match by falling weight, so that no comparison is made beyond it.
        """
        found = F
        for a, m in sorted(matches.items(), key=lambda x: -self.match_weights.get(x[0], 0.0)):
            found = found.when(m, F.lit(float(self.match_weights.get(a, 0.0))))
        return found.otherwise(F.lit(0.0)) if matches else F.lit(0.0)

    def logit(self, customer_term: Column, product_term: Column, bonus: Column) -> Column:
        return F.round(customer_term + product_term + bonus, DECIMALS)

    def score_pairs(self, training: DataFrame) -> DataFrame:
        """Adds ``logit`` and ``probability`` to a frame with pair features."""
        matches = {f.attribute: F.col(f.match) for f in FAVOURITES}
        lg = self.logit(self.customer_term(F.col("total_purchases")),
                        self.product_term(F.col("popularity")), self.match_bonus(matches))
        return training.withColumn("logit", lg).withColumn("probability", probability(F.col("logit")))


def fit_match_weights(training: DataFrame) -> DataFrame:
    """(attribute, weight) learned from labelled pairs in one aggregate.

    The weight of an attribute is the log odds ratio of its match flag,
    ln(P(match | bought) / P(match | drawn)) with one pseudo-pair of either
    kind, and zero where a match speaks against a purchase: the exact top-k
    needs non-negative weights.
    """
    y = F.col(LABEL_COL)
    counts = [F.sum(F.when(y == c, 1).otherwise(0)).alias(f"n{c}") for c in (0, 1)]
    counts += [F.sum(F.when((y == c) & F.col(f.match).cast("boolean"), 1).otherwise(0)).alias(f"{f.attribute}_{c}")
               for f in FAVOURITES for c in (0, 1)]
    share = lambda a, c: (F.col(f"{a}_{c}") + 1.0) / (F.col(f"n{c}") + 2.0)
    rows = [F.struct(F.lit(f.attribute).alias("attribute"),
                     F.round(F.greatest(F.lit(0.0), F.log(share(f.attribute, 1) / share(f.attribute, 0))), 6).alias("weight"))
            for f in FAVOURITES]
    return training.agg(*counts).select(F.inline(F.array(*rows)))


def fitted_scorer(weights: DataFrame, base: AffinityScorer = AffinityScorer()) -> AffinityScorer:
    """``base`` with learned match weights (one row per attribute)."""
    return replace(base, match_weights={r["attribute"]: r["weight"] for r in weights.collect()})


def probability(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


# ---------------------------------------------------------------- boosted trees

MISSING = -1.0e9
DATE_FEATURES = ["time_date", "last_purchase_date", "first_purchase_date"]
TEXT_FEATURES = ["prod_group_name"]
NUMERIC_FEATURES = [c for c in MODEL_FEATURES if c not in DATE_FEATURES + TEXT_FEATURES]


@dataclass(frozen=True)
class TreeParams:
    max_iter: int = 100
    max_depth: int = 5
    step_size: float = 0.08
    subsampling_rate: float = 0.9
    seed: int = 73
    #: raised to the number of text values where there are more
    max_bins: int = 32
    max_memory_mb: int = 1024


def model_frame(training: DataFrame) -> DataFrame:
    """Numeric model inputs: dates as day numbers, booleans as 0/1, missing -> sentinel."""
    cols = [F.coalesce(F.unix_date(F.col(c)).cast("double"), F.lit(MISSING)).alias(c) for c in DATE_FEATURES]
    cols += [F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(c) for c in NUMERIC_FEATURES]
    cols += [F.col(c) for c in TEXT_FEATURES]
    keep = [c for c in ("split", "customer_id", "product_id", LABEL_COL) if c in training.columns]
    return training.select(*keep, *cols)


def text_indexer():
    """Codes of the text features by falling frequency, ties by value; unseen and missing text get one more."""
    from pyspark.ml.feature import StringIndexer

    return StringIndexer(inputCols=TEXT_FEATURES, outputCols=[c + "_idx" for c in TEXT_FEATURES], handleInvalid="keep")


def model_frame_indexed(training: DataFrame) -> DataFrame:
    """The model frame with its text codes, fitted on the training split."""
    from affinity.session import stored

    frame = stored(model_frame(training), "model-frame")
    return text_indexer().fit(frame.where(F.col("split") == "train")).transform(frame).drop(*TEXT_FEATURES)


def tree_pipeline(params: TreeParams = TreeParams(), indexer=None):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    indexer = indexer or text_indexer()
    assembler = VectorAssembler(
        inputCols=DATE_FEATURES + NUMERIC_FEATURES + [c + "_idx" for c in TEXT_FEATURES],
        outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=LABEL_COL, featuresCol="features", maxIter=params.max_iter,
                        maxDepth=params.max_depth, stepSize=params.step_size,
                        subsamplingRate=params.subsampling_rate, seed=params.seed, maxBins=params.max_bins,
                        maxMemoryInMB=params.max_memory_mb,
                        cacheNodeIds=False)  # for shallow trees, walking down costs less than a table of node ids a level
    return Pipeline(stages=[indexer, assembler, gbt])


def fit_trees(training: DataFrame, params: TreeParams = TreeParams()):
    """Fit on the frame given (pass the training split) (M1, M3).

    The learner reads its input several times (split points, binning, the
    boosting rounds), so the model frame is written once to the shared
    checkpoint folder, as compressed columns: upstream joins run once and a
    lost executor re-reads files instead of recomputing the lineage. A text feature is a
    category of the trees, so there are at least as many bins as it has values.
    """
    from affinity.session import checkpoint_dir, stored

    checkpoint_dir(training.sparkSession)  # the learner cuts the lineage of its rounds there
    frame = stored(model_frame(training), "model-frame")
    indexer = text_indexer().fit(frame)
    values = max(map(len, indexer.labelsArray)) + 1
    return tree_pipeline(replace(params, max_bins=max(params.max_bins, values)), indexer).fit(frame)


def tree_scores(model, frame: DataFrame) -> DataFrame:
    """Class-1 probability per pair (M2)."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(model_frame(frame))
    keep = [c for c in ("split", "customer_id", "product_id", LABEL_COL) if c in out.columns]
    return out.select(*keep, vector_to_array(F.col("probability"))[1].alias("probability"))


def save_model(model, path: str) -> None:
    """Persist the fitted pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def _search_inputs(training: DataFrame, n_configs: int, folds: int, seed: int, grid: dict | None, shares: bool = False):
    """(frame with a keyed ``fold`` and, for ``shares``, a keyed ``draw``, pipeline, settings sampled from the grid).

    Keys are the text of a whole row, so they are made once and stored: a fit alone reads its rows several times.
    """
    import random

    from pyspark.ml.tuning import ParamGridBuilder

    from affinity.functions.draws import hash60, key_text
    from affinity.session import checkpoint_dir, stored

    checkpoint_dir(training.sparkSession)
    frame = model_frame(training)
    keyed = frame.withColumn("fold", F.pmod(hash60(key_text(F.lit(seed), *[F.col(c) for c in frame.columns])),
                                            F.lit(folds)).cast("int"))
    if shares:
        keyed = keyed.withColumn("draw", hash60(key_text(F.lit(f"{seed} share"), *[F.col(c) for c in keyed.columns])))
    frame = stored(keyed, "search-frame")
    indexer = text_indexer().fit(frame)
    values = max(map(len, indexer.labelsArray)) + 1
    pipe = tree_pipeline(TreeParams(max_bins=max(TreeParams().max_bins, values)), indexer)
    gbt = pipe.getStages()[-1]
    grid = grid or {"maxIter": [20, 50, 100], "maxDepth": [3, 5, 7], "stepSize": [0.05, 0.08, 0.1],
                    "subsamplingRate": [0.8, 0.9, 1.0]}
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(gbt.getParam(name), values)
    maps = builder.build()
    return frame, pipe, random.Random(seed).sample(maps, min(n_configs, len(maps)))


def _auc():
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    return BinaryClassificationEvaluator(labelCol=LABEL_COL, metricName="areaUnderROC")


def _fits_at_a_time(frame: DataFrame, fits: int) -> int:
    """As many fits as give every core two tasks: a level of a tree is a task a partition, then a wait for the driver.

    Each holds its binned rows and more of them only share the cores, so a table of as many partitions as cores has two at a time.
    """
    tasks = 2 * frame.sparkSession.sparkContext.defaultParallelism
    return min(fits, max(2, tasks // max(1, frame.rdd.getNumPartitions())))


def random_search(training: DataFrame, n_configs: int = 5, folds: int = 2, seed: int = 73,
                  parallelism: int | None = None, grid: dict | None = None):
    """Randomised search: ``n_configs`` settings sampled from a grid, k-fold CV on AUC (M4).

    A row's fold is a keyed draw from its own values, so folds don't depend on
    row order or partitioning. Settings and folds are fitted beside each other, the
    longest first, ``parallelism`` at a time (default: as many as keep the cores at work).
    Returns the fitted ``CrossValidatorModel``; ``avgMetrics`` lines up with
    ``getEstimatorParamMaps()``.
    """
    from multiprocessing.pool import ThreadPool

    import numpy as np
    from pyspark import inheritable_thread_target
    from pyspark.ml.tuning import CrossValidator, CrossValidatorModel

    frame, pipe, chosen = _search_inputs(training, n_configs, folds, seed, grid)
    frame = frame.cache()  # once for all fits: each reads its rows several times

    def score(fit: tuple[int, int]) -> tuple[int, int, float]:
        k, f = fit
        fitted = pipe.fit(frame.where(F.col("fold") != f), chosen[k])
        return k, f, _auc().evaluate(fitted.transform(frame.where(F.col("fold") == f)))

    def levels(fit: tuple[int, int]) -> int:
        gbt = pipe.getStages()[-1].copy(chosen[fit[0]])
        return gbt.getMaxIter() * gbt.getMaxDepth()

    try:
        held = {r.fold for r in frame.select("fold").distinct().collect()}
        for f in range(folds):
            if held <= {f}:
                raise ValueError(f"The training data at fold {f} is empty.")
            if f not in held:
                raise ValueError(f"The validation data at fold {f} is empty.")
        fits = sorted(((k, f) for k in range(len(chosen)) for f in range(folds)), key=levels, reverse=True)
        aucs = np.zeros((folds, len(chosen)))
        with ThreadPool(parallelism or _fits_at_a_time(frame, len(fits))) as pool:
            for k, f, auc in pool.imap_unordered(inheritable_thread_target(frame.sparkSession)(score), fits):
                aucs[f, k] = auc
        averages = aucs.mean(axis=0)
        best = pipe.fit(frame, chosen[int(averages.argmax())])
    finally:
        frame.unpersist()
    found = CrossValidatorModel(best, avgMetrics=averages.tolist(), stdMetrics=aucs.std(axis=0).tolist())
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=chosen, numFolds=folds, seed=seed, foldCol="fold", evaluator=_auc())
    for p, value in cv.extractParamMap().items():
        if found.hasParam(p.name):
            found.set(found.getParam(p.name), value)
    return found


def _setting(params) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda x: x[0].name))


def halving_search(training: DataFrame, n_configs: int = 5, folds: int = 2, seed: int = 73, parallelism: int = 2,
                   grid: dict | None = None, eta: int = 3, refit: bool = True):
    """The search by successive halving (M4): (fitted pipeline or None, report).

    All sampled settings are tried on a share of the rows, the best of every
    ``eta`` go on to ``eta`` times as many, and the last is scored on all rows.
    Shares are nested keyed draws, folds those of `random_search`, so neither
    depends on row order or partitioning. Where a share leaves a training or
    held-out side without both labels, it is passed over and every setting goes on.
    The report has a row per setting and share: setting, share, auc_roc, kept.
    """
    from multiprocessing.pool import ThreadPool

    from pyspark.ml import PipelineModel

    frame, pipe, alive = _search_inputs(training, n_configs, folds, seed, grid, shares=True)
    *prepare, gbt = pipe.getStages()
    ready = PipelineModel(prepare).transform(frame)
    values = max(map(len, prepare[0].labelsArray)) + 1
    left = [len(alive)]
    while left[-1] > 1:
        left.append(-(-left[-1] // eta))
    report = []
    for rung, keep in enumerate([*left[1:], 1]):
        share = eta ** (rung + 1 - len(left))
        rows = ready.where(F.col("draw") < int(share * (1 << 60)))
        held = {(r.fold, r.label): r.n for r in rows.groupBy("fold", F.col(LABEL_COL).alias("label")).agg(F.count("*").alias("n")).collect()}
        if share < 1 and len(held) < 2 * folds:
            continue
        if min(sum(n for (fold, _), n in held.items() if fold != f) for f in range(folds)) < values:
            rows = rows.withMetadata("features", {})  # the learner refuses categories of more values than it has rows: codes are numbers then

        def score(params) -> float:
            aucs = [_auc().evaluate(gbt.fit(rows.where(F.col("fold") != f), params).transform(rows.where(F.col("fold") == f)))
                    for f in range(folds)]
            return sum(aucs) / folds

        with ThreadPool(min(parallelism, len(alive))) as pool:
            aucs = pool.map(score, alive)
        best = sorted(range(len(alive)), key=lambda k: (-aucs[k], k))[:keep]
        report += [(_setting(p), float(share), float(a), k in best) for k, (p, a) in enumerate(zip(alive, aucs))]
        alive = [alive[k] for k in sorted(best)]
    fitted = PipelineModel([*prepare, gbt.fit(ready, alive[0])]) if refit else None
    return fitted, training.sparkSession.createDataFrame(report, "setting string, share double, auc_roc double, kept boolean")


def search_report(spark, fitted) -> DataFrame:
    """(setting, auc_roc) of every setting that a random search tried: as many rows as it had settings."""
    rows = [(_setting(m), float(a)) for m, a in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics)]
    return spark.createDataFrame(rows, "setting string, auc_roc double")
