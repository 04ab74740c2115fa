import os
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from affinity.functions.draws import hash60, key_text
from affinity.operators import model, recommend
from affinity.operators.pairs import MODEL_FEATURES, TRAINING_COLUMNS
from affinity.operators.tree_topk import tree_top_k
from affinity.plans import catalog
from affinity.sources import tables

from conftest import SF_SMALL

# Column order of the reference's model frame.
REFERENCE_ORDER = [
    "time_date", "customer_id", "product_id", "last_purchase_date", "first_purchase_date", "total_purchases",
    "total_spent", "link_pred_baseline_target", "prod_group_name", "average_price", "price_std", "popularity",
    "perceived_color_match", "prod_group_match", "idx_group_match", "sec_no_match", "garment_group_no_match",
    "idx_code_match", "department_no_match", "prod_type_no_match", "graph_appearance_no_match",
    "colour_group_code_match", "perceived_colour_master_id_match", "age_similarity", "FN_similarity",
    "active_similarity", "member_similarity", "news_similarity",
]


def test_training_columns_follow_reference_order(spark):
    assert TRAINING_COLUMNS == REFERENCE_ORDER
    assert len(MODEL_FEATURES) == 25
    ts = catalog.Inputs(spark, SF_SMALL).training_set()
    assert ts.columns == ["split"] + REFERENCE_ORDER


def test_trees_fit_save_load(spark):
    ts = catalog.Inputs(spark, SF_SMALL).training_set()
    params = model.TreeParams(max_iter=5, max_depth=3)
    fitted = model.fit_trees(ts.where(F.col("split") == "train"), params)
    val = ts.where(F.col("split") == "val")
    a = model.tree_scores(fitted, val)
    path = os.path.join(tempfile.mkdtemp(prefix="affinity-model-"), "m")
    model.save_model(fitted, path)
    b = model.tree_scores(model.load_model(path), val)
    key = ["customer_id", "product_id", "link_pred_baseline_target", "probability"]
    assert a.select(*key).exceptAll(b.select(*key)).count() == 0
    probs = [r.probability for r in a.collect()]
    assert probs and all(0.0 <= p <= 1.0 for p in probs)


def test_random_search_small(spark):
    ts = catalog.Inputs(spark, SF_SMALL).training_set().where(F.col("split") == "train")
    cv = model.random_search(ts, n_configs=2, folds=2, grid={"maxIter": [2, 3], "maxDepth": [2]})
    assert len(cv.avgMetrics) == 2 and all(0.0 <= m <= 1.0 for m in cv.avgMetrics)


def test_train_and_score_jobs(spark):
    from affinity.plans import jobs

    out = tempfile.mkdtemp(prefix="affinity-jobs-")
    report = jobs.train(spark, SF_SMALL, out, model.TreeParams(max_iter=3, max_depth=3))
    got = {(r.split, r.scorer, r.metric) for r in report.collect()}
    assert ("val", "boosted_trees", "auc_roc") in got and ("train", "affinity", "accuracy") in got
    recs = jobs.score(spark, SF_SMALL, out)
    assert recs.count() == tables.requests(spark, SF_SMALL).count()
    assert os.path.exists(os.path.join(out, "submission"))
    # the saved trees, loaded again, rank the products
    i = catalog.Inputs(spark, SF_SMALL)
    by_trees = jobs.score(spark, SF_SMALL, out, by="trees")
    top = tree_top_k(model.load_model(os.path.join(out, "model")), i.requests, i.customers_wf(), i.products_wf(), i.scoring_date)
    assert sorted(map(str, by_trees.collect())) == sorted(map(str, recommend.recommendations(i.requests, top).collect()))
    lines = spark.read.text(os.path.join(out, "predictions_text")).toDF("line")
    assert recommend.unparsed_prediction_lines(lines).count() == 0
    assert recommend.parse_prediction_lines(lines).count() == by_trees.count()


def test_trees_fit_with_many_text_values(spark):
    ts = catalog.Inputs(spark, SF_SMALL).training_set().withColumn(
        "prod_group_name", F.concat(F.lit("g"), (F.col("product_id") % 40).cast("string")))
    fitted = model.fit_trees(ts.where(F.col("split") == "train"), model.TreeParams(max_iter=2, max_depth=2))
    assert model.tree_scores(fitted, ts).where("probability is null").count() == 0


def test_registered_search_draws_from_the_whole_grid(spark, monkeypatch):
    given = []
    monkeypatch.setattr(catalog, "random_search", lambda *a, **k: given.append((len(a), k)))
    monkeypatch.setattr(catalog, "search_report", lambda *a: None)
    catalog.queries()["random_search_report"](spark, SF_SMALL)
    assert given == [(1, {})]


def test_random_search_does_not_depend_on_partitions(spark):
    ts = catalog.Inputs(spark, SF_SMALL).training_set().where(F.col("split") == "train")
    grid = {"maxIter": [2], "maxDepth": [1, 2]}
    a, b = (model.random_search(t, n_configs=2, grid=grid).avgMetrics for t in (ts.repartition(3), ts.repartition(5)))
    assert all(abs(x - y) < 0.02 for x, y in zip(a, b))


def test_random_search_fits_settings_and_folds_beside_each_other(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.tuning import CrossValidator

    ts = catalog.Inputs(spark, SF_SMALL).training_set().where(F.col("split") == "train")
    inputs = model._search_inputs(ts, 2, 2, 73, {"maxIter": [1, 2], "maxDepth": [2]})
    monkeypatch.setattr(model, "_search_inputs", lambda *a, **k: inputs)
    frame, pipe, chosen = inputs
    plain = CrossValidator(estimator=pipe, estimatorParamMaps=chosen, numFolds=2, foldCol="fold", evaluator=model._auc()).fit(frame)

    # the four fits of two settings and two folds are at work at the same time, the longest begun first
    fit, met, begun = Pipeline.fit, threading.Barrier(4, timeout=60), []

    def meeting(self, rows, params):
        begun.append(next(v for p, v in params.items() if p.name == "maxIter"))
        if len(begun) <= 4:
            met.wait()
        return fit(self, rows, params)

    monkeypatch.setattr(Pipeline, "fit", meeting)
    cv = model.random_search(ts, n_configs=2, folds=2)
    assert sorted(begun[:4]) == [1, 1, 2, 2] and len(begun) == 5
    assert all(abs(a - b) < 1e-4 for a, b in zip(cv.avgMetrics, plain.avgMetrics))
    assert all(abs(a - b) < 1e-4 for a, b in zip(cv.stdMetrics, plain.stdMetrics))
    assert cv.getEstimatorParamMaps() == chosen and cv.getNumFolds() == 2 and cv.getFoldCol() == "fold"
    assert cv.bestModel.stages[-1].toDebugString.split("\n")[1:] == plain.bestModel.stages[-1].toDebugString.split("\n")[1:]

    # a fold without rows has nothing to be scored on
    inputs = frame.where("fold = 0"), pipe, chosen
    with pytest.raises(ValueError, match="training data at fold 0 is empty"):
        model.random_search(ts, n_configs=2, folds=2)
    inputs = frame, pipe, chosen
    with pytest.raises(ValueError, match="validation data at fold 2 is empty"):
        model.random_search(ts, n_configs=2, folds=3)


def test_search_has_as_many_fits_at_a_time_as_the_cores_take(spark):
    cores = spark.sparkContext.defaultParallelism
    of = lambda parts, fits=10: model._fits_at_a_time(spark.range(0, 100, 1, parts).toDF("x"), fits)
    assert of(1) == min(10, 2 * cores) and of(cores) == 2 and of(20 * cores) == 2 and of(20 * cores, 1) == 1


def test_halving_search_finds_the_winner_of_the_full_search(spark):
    ts = catalog.Inputs(spark, SF_SMALL).training_set().where(F.col("split") == "train")
    grid = {"maxIter": [1, 6], "maxDepth": [1, 4]}
    cv = model.random_search(ts, n_configs=4, grid=grid)
    full = {r.setting: r.auc_roc for r in model.search_report(spark, cv).collect()}
    fitted, report = model.halving_search(ts.repartition(3), n_configs=4, grid=grid, eta=2)
    rows = report.collect()
    assert [(r.share, r.kept) for r in rows].count((0.25, True)) == 2 and len(rows) == 4 + 2 + 1
    assert {r.setting for r in rows if r.share == 0.25} == set(full)
    last = rows[-1]
    assert last.share == 1 and last.kept and last.setting == max(full, key=full.get)
    assert abs(last.auc_roc - full[last.setting]) < 0.02
    assert model.tree_scores(fitted, ts).where("probability is null").count() == 0
    # too few rows for a share with both labels on both sides: every setting goes on to all rows
    few = ts.where(F.col(model.LABEL_COL) == 1).limit(3).unionByName(ts.where(F.col(model.LABEL_COL) == 0).limit(3))
    _, report = model.halving_search(few, n_configs=2, grid={"maxIter": [1], "maxDepth": [1, 2]}, eta=100, refit=False)
    assert [r.share for r in report.collect()] == [1.0, 1.0]


def test_search_keys_are_stored_not_made_in_every_pass(spark):
    ts = catalog.Inputs(spark, SF_SMALL).training_set().where(F.col("split") == "train")
    frame, pipe, _ = model._search_inputs(ts, 1, 2, 73, {"maxIter": [1]}, shares=True)
    *prepare, _ = pipe.getStages()
    assert "md5" not in prepare[0].transform(frame)._jdf.queryExecution().toString()
    columns = [F.col(c) for c in frame.columns if c != "draw"]
    want = hash60(key_text(F.lit("73 share"), *columns))
    assert frame.count() and frame.where(F.col("draw") != want).count() == 0


def test_jobs_run_on_csv_files(spark):
    """The six CSV files of the reference's layout, written from the tables: same features, weights and predictions."""
    from affinity.plans import jobs

    d = tempfile.mkdtemp(prefix="affinity-csv-")
    i = catalog.Inputs(spark, SF_SMALL)
    lists = i.positives.groupBy("split", "time_date", "customer_id").agg(
        F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("product_id")), " "), F.lit("]")).alias("list_product_id"))
    frames = {"customers": i.customers, "products": i.products.withColumn("detail_desc", F.lit('a "b",\nc')),
              "transactions": i.all_tx, "requests": i.requests,
              "train_labels": lists.where("split = 'train'").drop("split"), "val_labels": lists.where("split = 'val'").drop("split")}
    paths = {}
    for name, df in frames.items():
        paths[name] = os.path.join(d, f"{name}.csv")
        pdf = df.toPandas()
        for c in pdf.columns:  # ids with gaps are floats in pandas
            if c.endswith(("_no", "_code", "_id")) and pdf[c].dtype == float:
                pdf[c] = pdf[c].astype("Int64")
        pdf.to_csv(paths[name], index=False)
    out = os.path.join(d, "out")
    report = jobs.train(spark, paths, out, model.TreeParams(max_iter=2, max_depth=2))
    assert ("val", "affinity_fitted", "auc_roc") in {(r.split, r.scorer, r.metric) for r in report.collect()}
    a = {(r.customer_id, r.total_purchases, round(r.total_spent, 6)) for r in spark.read.parquet(f"{out}/customer_features").collect()}
    assert a == {(r.customer_id, r.total_purchases, round(r.total_spent, 6)) for r in i.customer_features().collect()}
    scorer = model.fitted_scorer(spark.read.parquet(f"{out}/weights"))
    recs = sorted(map(str, jobs.score(spark, ",".join(f"{k}={v}" for k, v in paths.items()), out).collect()))
    assert recs == sorted(map(str, catalog.Inputs(spark, SF_SMALL, scorer).recommendations().collect()))
