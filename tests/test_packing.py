"""Packed columns come back with the same values, whether they fit a lane or not."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.functions.packing import folded, packed, packed_text, unfolded, unpacked, unpacked_text
from affinity.operators import features as feat
from affinity.operators import labels, pairs
from affinity.plans import catalog
from affinity.sources import schemas

from conftest import SF_SMALL


def test_packed_values_come_back(spark):
    rows = [(1, 0, None, 32766, 5, 7, "x", 0.5, -1.0, None), (2, None, None, None, None, None, None, None, None, None),
            (3, -1, 2, 3, 4, 32767, "y", 1e300, 0.25, float("nan")), (4, 9, 2 ** 62, 3, 4, 5, "z", -0.0, float("inf"), 8191.0),
            (5, 1, 2, 3, 4, 5, "w", -8192.0, 8191.0, 76.5)]
    df = spark.createDataFrame(rows, "id bigint, a bigint, b bigint, c bigint, d bigint, e bigint, t string, x double, y double, z double")
    columns = ["a", "t", "b", "x", "c", "y", "d", "z", "e"]
    small = packed(df, columns)
    assert small.where("id = 5 and (a is not null or e is not null or x is not null or packed_x is null)").count() == 0
    back = unpacked(small, columns)
    assert back.columns == df.columns and back.dtypes == df.dtypes
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    missed = unpacked(spark.range(1).join(small.drop("id").limit(0), F.lit(True), "left"), columns)
    assert set(missed.drop("id").first()) == {None}


def _entities(spark):
    product = lambda pid, sec: tuple({"product_id": pid, "sec_no": sec, "prod_group_name": f"g{sec}"}.get(n) for n in schemas.PRODUCTS.fieldNames())
    anything = T.StructType([T.StructField(f.name, f.dataType) for f in schemas.PRODUCTS])
    products = spark.createDataFrame([product(1, 5), product(2, 6), product(2, 6), product(3, 99999), product(None, 5)], anything)
    customers = spark.createDataFrame([(c, 1.0, None, "ACTIVE", "NONE", 30.0 + c, None) for c in (1, 2, 2, 3)], schemas.CUSTOMERS)
    tx = spark.createDataFrame([(dt.date(2020, 1, 1), c, p, 2.0 * p, 1) for c, p in [(1, 1), (1, 2), (2, 3), (3, 2), (9, 1)]], schemas.TRANSACTIONS)
    return (feat.customers_with_features(customers, feat.customer_features(tx, products)),
            feat.products_with_features(products, feat.product_features(tx, customers)), products)


def test_labelled_with_entities_equals_the_two_steps(spark):
    """Repeated, null and unknown keys included."""
    cwf, pwf, products = _entities(spark)
    pos = spark.createDataFrame([("train", dt.date(2020, 1, d + 1), c, p, f"{d}") for d, (c, p) in enumerate(
        [(1, 1), (2, 2), (None, 3), (3, None), (7, 2), (2, 77), (1, 3), (3, 3), (2, 1)])],
        "split string, time_date date, customer_id bigint, product_id bigint, item_key string")
    want = pairs.with_pair_features(pairs.attach_entities(labels.labelled_pairs(pos, products), cwf, pwf))
    got = pairs.with_pair_features(pairs.labelled_with_entities(pos, products, cwf, pwf))
    assert set(got.columns) == set(want.columns)
    columns = sorted(want.columns)
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))
    assert got.count() > 2 * 9  # repeated entities repeat their pairs


def test_pairs_meet_customers_before_they_are_two(spark):
    """The customer join has a row per positive, and no join only turns drawn numbers into ids."""
    plan = catalog.queries()["training_set"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = {name: min(i for i, line in enumerate(plan) if text in line) for name, text in (("union", "Generate inline(array(struct"), ("customer", "customer_id#"))}
    joins = [line for line in plan if "Join" in line and "product_idx" in line]
    assert at["union"] and not joins


def test_rows_go_to_their_product_before_they_are_aggregated(spark):
    tx = spark.createDataFrame([(dt.date(2020, 1, 1), 1, 1, 2.0, 1)], schemas.TRANSACTIONS)
    customers = spark.createDataFrame([(1, 1.0, None, "ACTIVE", "NONE", 30.0, None)], schemas.CUSTOMERS)
    plan = feat.product_features(tx, customers)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression [product_id") < plan.index("Join")


def test_folded_rows_are_one_word_a_group_where_values_are_small(spark):
    rows = [(1, *range(10), 30.5, 0.0, dt.date(2020, 1, 1), "x"), (2, *range(120, 130), -1.0, None, None, None),
            (3, *range(-5, 5), 1e9, -0.0, dt.date(1492, 1, 1), "y"), (4, *[None] * 14)]
    names = [f"n{i}" for i in range(10)]
    df = spark.createDataFrame(rows, "id bigint, " + ", ".join(f"{n} bigint" for n in names) + ", a double, b double, d date, t string")
    columns = [*names, "a", "t", "b", "d"]
    small = folded(df, columns)
    # one word for nine numbers, one for the tenth, one for the doubles, one for the day, and nothing beside them
    assert small.columns == ["id", "t", "tight_n0", "tight_n9", "tight_a", "tight_d", "packed_wide", "packed_rest"]
    held = {r.id: (r.packed_wide, r.packed_rest) for r in small.collect()}
    assert held[1] == held[4] == (None, None) and held[2][0] is not None and held[2][1] is None and held[3][1] is not None
    back = unfolded(small, columns).select(df.columns)
    assert back.dtypes == df.dtypes and sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    missed = unfolded(spark.range(1).join(small.drop("id").limit(0), F.lit(True), "left"), columns)
    assert set(missed.drop("id").first()) == {None}


def test_keys_of_digits_travel_as_half_their_length(spark):
    texts = ["1:2:3", "12:3", "", "0:00", ":", "::", "7", "a", "1:b", "1:2\n", "F", "A", "-1:2", None, "0"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed_text(F.col("t")).alias("p")).select(
        "t", "p", unpacked_text(F.col("p")).alias("back")).collect()
    for r in got:
        assert (r.p is not None) == (r.t is not None and set(r.t) <= set("0123456789:")), r
        assert r.p is None or (r.back == r.t and len(r.p) == (len(r.t) + 1) // 2), r


def test_pairs_meet_written_entities(spark):
    """The shuffles that make the entity tables are over before pairs are joined; line items meet their orders once."""
    of = lambda name: catalog.queries()[name](spark, SF_SMALL).inputFiles()
    files = of("training_set")
    assert all(any(part in f for f in files) for part in ("/customers-wf-", "/products-wf-", "/sales-"))
    files = of("pair_features")
    assert all(any(part in f for f in files) for part in ("/customers-wf-", "/products-wf-"))
