import datetime as dt

from pyspark.sql import functions as F

from affinity.operators import features as feat
from affinity.sources import schemas, tables

from conftest import SF_SMALL

D = dt.date(2020, 1, 1)


def _products(spark, rows):
    """rows: (product_id, sec_no, prod_group_name, idx_group_no); other attributes null."""
    full = []
    names = schemas.PRODUCTS.fieldNames()
    for pid, sec, group, idx_group in rows:
        r = dict.fromkeys(names)
        r.update(product_id=pid, sec_no=sec, prod_group_name=group, idx_group_no=idx_group)
        full.append(tuple(r[n] for n in names))
    return spark.createDataFrame(full, schemas.PRODUCTS)


def _tx(spark, rows):
    return spark.createDataFrame([(D, c, p, price, 1) for c, p, price in rows], schemas.TRANSACTIONS)


def test_mode_ties_prefer_smallest_value(spark):
    prods = _products(spark, [(1, 10, "b", 3), (2, 2, "c", 1), (3, None, None, None)])
    tx = _tx(spark, [(7, 1, 1.0), (7, 1, 1.0), (7, 2, 1.0), (7, 2, 1.0), (8, 3, None), (8, 99, None)])
    got = {r.customer_id: r for r in feat.customer_features(tx, prods).collect()}
    assert got[7].top_sec_no == 2          # numeric tie: 2 < 10
    assert got[7].top_prod_group == "b"    # text tie: "b" < "c"
    assert got[7].top_idx_group_no == 1
    # customer 8 only bought a product with missing attributes and one unknown to the product table
    assert got[8].top_sec_no is None                # plain attribute: stays null
    assert got[8].top_prod_group == "b"             # category attribute: domain minimum
    assert got[8].top_idx_group_no == 1
    assert got[8].total_spent == 0.0                # all prices missing -> 0.0
    assert got[8].total_purchases == 2


def test_product_stats_edge_cases(spark):
    cust = spark.createDataFrame([(1, 1.0, 1.0, "ACTIVE", "NONE", 30.0, None), (2, 1.0, 1.0, "ACTIVE", "NONE", 30.0, None),
                                  (3, None, None, None, None, 50.0, None)], schemas.CUSTOMERS)
    tx = _tx(spark, [(1, 10, 5.0), (2, 10, 5.0), (3, 20, 7.0), (9, 10, 5.0)])
    got = {r.product_id: r for r in feat.product_features(tx, cust).collect()}
    assert got[10].price_std == 0.0         # repeated single price: stays 0
    assert got[10].std_age == 1.0           # equal ages: 0 -> 1
    assert got[10].popularity == 3          # the unknown buyer still counts for popularity
    assert got[10].average_age == 30.0      # ... but not for demographics
    assert got[20].std_age is None          # one buyer: null
    assert got[20].price_std is None


def test_mode_equals_rownumber_form(spark):
    tx, prods = tables.transactions(spark, SF_SMALL), tables.products(spark, SF_SMALL)
    wide = feat.favourites(tx, prods, closed_domain=False)
    longf = wide.unpivot(["customer_id"], [F.col(c).cast("string").alias(c) for c in feat.TOP_COLUMNS],
                         "top", "top_value").where(F.col("top_value").isNotNull())
    names = dict(zip(feat.TOP_COLUMNS, feat.ATTRIBUTES))
    a = {(r.customer_id, names[r.top], r.top_value) for r in longf.collect()}
    b = {(r.customer_id, r.attribute, r.top_value)
         for r in feat.favourites_rownumber(feat.attribute_counts(tx, prods), prods).collect()}
    assert a == b and len(a) > 0


def test_customer_features_single_customer_exchange(spark):
    tx, prods = tables.transactions(spark, SF_SMALL), tables.products(spark, SF_SMALL)
    plan = feat.customer_features(tx, prods)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(customer_id") == 1
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_counts_and_favourites_meet_by_customer_once(spark):
    """The rows are shuffled by customer, not the long counts: neither the count nor the ranking adds an exchange."""
    tx, prods = tables.transactions(spark, SF_SMALL), tables.products(spark, SF_SMALL)
    counts = feat.attribute_counts(tx, prods)
    for df in (counts, feat.favourites_rownumber(counts, prods), feat.favourites(tx, prods)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(customer_id") == 1 and "REPARTITION_BY_COL" in plan
    # what crosses that exchange are the rows: nothing is counted before it
    assert "partial_count" not in counts._jdf.queryExecution().executedPlan().toString().split("REPARTITION_BY_COL")[1]
