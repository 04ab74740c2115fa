import datetime as dt

from pyspark.sql import functions as F

from affinity.operators import labels
from affinity.sources import schemas, tables

from conftest import SF_SMALL


def test_explode_keeps_empty_and_repeated(spark):
    lists = spark.createDataFrame([(dt.date(2020, 1, 1), 1, "[]"), (dt.date(2020, 1, 2), 2, "[5 5]")],
                                  schemas.LABEL_LISTS)
    rows = sorted((r.customer_id, r.product_id, r.item_key) for r in labels.explode_labels(lists).collect())
    assert rows == [(1, None, ""), (2, 5, "0"), (2, 5, "1")]


def test_negatives_one_per_positive_and_existing_ids(spark):
    pos = tables.label_items(spark, SF_SMALL)
    prods = tables.products(spark, SF_SMALL)
    neg = labels.sample_negatives(pos, prods)
    assert neg.count() == pos.count()
    assert neg.join(prods, "product_id", "left_anti").count() == 0
    # positives, in contrast, refer to products that the table doesn't have
    assert pos.where("product_id is not null").join(prods, "product_id", "left_anti").count() > 0
    assert set(neg.select("link_pred_baseline_target").distinct().toPandas().iloc[:, 0]) == {0}


def test_negatives_do_not_depend_on_partitioning(spark):
    pos = tables.label_items(spark, SF_SMALL)
    prods = tables.products(spark, SF_SMALL)
    a = labels.sample_negatives(pos.repartition(1), prods.repartition(1))
    b = labels.sample_negatives(pos.repartition(7), prods.repartition(5))
    key = ["split", "time_date", "customer_id", "item_key", "product_id"]
    assert a.select(*key).exceptAll(b.select(*key)).count() == 0
    assert b.select(*key).exceptAll(a.select(*key)).count() == 0


def test_numbering_is_a_bijection(spark):
    prods = tables.products(spark, SF_SMALL)
    num = labels.number_products(prods, buckets=16).toPandas()
    assert sorted(num.product_idx) == list(range(len(num)))
    assert num.product_id.is_unique


def test_label_items_match_list_semantics(spark):
    """Exploding per customer-day lists equals the join-based positives (as bags)."""
    od = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("o_custkey", tables._reference("o_custkey"))
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("l_partkey", tables._reference("l_partkey"))
    lists = (od.join(li, od.o_orderkey == li.l_orderkey, "left")
             .groupBy(F.col("o_orderdate").cast("date").alias("time_date"), F.col("o_custkey").alias("customer_id"))
             .agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("l_partkey")), " "), F.lit("]"))
                  .alias("list_product_id")))
    a = labels.explode_labels(lists).select("time_date", "customer_id", "product_id")
    b = tables.label_items(spark, SF_SMALL).select("time_date", "customer_id", "product_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_strict_negatives_avoid_known_positives(spark):
    pos = tables.label_items(spark, SF_SMALL)
    prods = tables.products(spark, SF_SMALL)
    neg = labels.sample_negatives_strict(pos, prods, per_round=2)
    assert neg.count() == pos.count()
    clash = neg.join(pos.select("split", "customer_id", "product_id"), ["split", "customer_id", "product_id"])
    assert clash.count() == 0
    assert neg.where("product_id is null").count() == 0


def test_strict_negatives_when_every_product_is_known(spark):
    prods = spark.createDataFrame([(p,) for p in range(3)], "product_id bigint")
    d = dt.date(2020, 1, 1)
    pos = spark.createDataFrame(
        [("train", d, 1, p, str(p)) for p in range(3)] + [("train", d, 2, 0, "0")],
        "split string, time_date date, customer_id bigint, product_id bigint, item_key string")
    got = sorted((r.customer_id, r.product_id) for r in labels.sample_negatives_strict(pos, prods, per_round=1).collect())
    assert got[:3] == [(1, None), (1, None), (1, None)]
    assert got[3][0] == 2 and got[3][1] in (1, 2)


def test_strict_negatives_of_a_customer_who_has_nearly_everything(spark):
    """399 of 400 products: doubling rounds find the last one; the result does not depend on the first round's size."""
    prods = spark.createDataFrame([(p,) for p in range(400)], "product_id bigint")
    d = dt.date(2020, 1, 1)
    pos = spark.createDataFrame([("train", d, 1, p, str(p)) for p in range(399)],
                                "split string, time_date date, customer_id bigint, product_id bigint, item_key string")
    a = labels.sample_negatives_strict(pos, prods, per_round=16).collect()
    assert len(a) == 399 and {r.product_id for r in a} == {399}


def test_strict_negatives_do_not_depend_on_rounds(spark):
    pos = tables.label_items(spark, SF_SMALL).where("customer_id % 10 = 3")
    prods = tables.products(spark, SF_SMALL)
    a, b = (sorted(map(tuple, labels.sample_negatives_strict(pos, prods, per_round=n).collect())) for n in (1, 8))
    assert a == b


def test_labelled_pairs_compute_positives_once(spark):
    pos, prods = tables.label_items(spark, SF_SMALL), tables.products(spark, SF_SMALL)
    plan = labels.labelled_pairs(pos, prods)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") <= 2 and plan.count("lineitem.parquet") <= 2


def test_strict_negatives_of_rows_with_null_keys(spark):
    """Null split, customer, date, product and item key: every row comes back, null customers share their known products."""
    d = dt.date(2020, 9, 20)
    rows = [("train", d, None, 1, "a"), ("train", d, None, 2, "b"), ("train", None, 5, 3, "c"), ("train", d, 5, None, None),
            (None, d, 5, 1, "d"), ("train", None, None, None, None), ("train", d, None, 1, "a")]
    pos = spark.createDataFrame(rows, "split string, time_date date, customer_id bigint, product_id bigint, item_key string")
    prods = spark.createDataFrame([(i,) for i in (1, 2, 3)], "product_id bigint")
    got = sorted(map(str, labels.sample_negatives_strict(pos, prods, per_round=4).select("split", "time_date", "customer_id", "item_key").collect()))
    assert got == sorted(map(str, pos.select("split", "time_date", "customer_id", "item_key").collect()))
    neg = {(r.split, r.customer_id, r.item_key): r.product_id for r in labels.sample_negatives_strict(pos, prods).collect()}
    assert neg["train", None, "a"] == neg["train", None, "b"] == neg["train", None, None] == 3
    assert neg["train", 5, "c"] in (1, 2) and neg["train", 5, None] in (1, 2) and neg[None, 5, "d"] in (2, 3)
    assert {r.product_id for r in labels.sample_negatives_strict(pos, prods.limit(0)).collect()} == {None}


def test_strict_negatives_go_on_with_refused_draws_only(spark, monkeypatch):
    """Every row makes one draw; what is drawn again are the rows whose first draw was a positive, copies kept."""
    d = dt.date(2020, 1, 1)
    prods = spark.createDataFrame([(p,) for p in range(50)], "product_id bigint")
    pos = spark.createDataFrame([("train", d, c, p, str(p)) for c in range(20) for p in (c, c + 1, c + 1)],
                                "split string, time_date date, customer_id bigint, product_id bigint, item_key string")
    written = {}

    def counted(df, tag, to=labels.stored):
        out = to(df, tag)
        written.setdefault(tag, []).append(out.count())
        return out

    monkeypatch.setattr(labels, "stored", counted)
    neg = labels.sample_negatives_strict(pos, prods)
    first = labels.with_negatives(pos.withColumn("item_key", F.concat("item_key", F.lit("|0"))), prods)
    own = {(c, p) for c in range(20) for p in (c, c + 1)}
    refused = {(r.customer_id, r.product_id) for r in first.collect() if (r.customer_id, r.negative) in own}
    assert 0 < written["open"][0] == len(refused) < 40
    assert written["first-draws"] == [60] and neg.count() == 60
    assert neg.groupBy("customer_id").count().where("count <> 3").count() == 0
    assert not own & {(r.customer_id, r.product_id) for r in neg.collect()}
