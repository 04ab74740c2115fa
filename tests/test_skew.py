"""A hot customer and a hot product each hold a third of all transactions:
features and recommendations stay exact, and the aggregates are combined
map-side before the shuffle."""

import datetime as dt
import random

import pandas as pd

from affinity.operators import features as feat
from affinity.operators import recommend
from affinity.sources import schemas


def _data(spark):
    rng = random.Random(5)
    names = schemas.PRODUCTS.fieldNames()
    prods = []
    for pid in range(50):
        r = dict.fromkeys(names)
        r.update(product_id=pid, sec_no=pid % 7, department_no=pid % 5, prod_group_name=f"g{pid % 3}",
                 idx_group_no=pid % 4, garment_group_no=pid % 6, idx_code="ABC"[pid % 3])
        prods.append(tuple(r[n] for n in names))
    tx = []
    for i in range(3000):
        c = 0 if i % 3 == 0 else rng.randrange(1, 200)          # customer 0: a third of all rows
        p = 7 if i % 3 == 1 else rng.randrange(50)              # product 7: another third
        tx.append((dt.date(2020, 1, 1) + dt.timedelta(days=i % 90), c, p, float(rng.randrange(100, 999)) / 100, 1))
    return (spark.createDataFrame(prods, schemas.PRODUCTS), spark.createDataFrame(tx, schemas.TRANSACTIONS),
            pd.DataFrame(tx, columns=schemas.TRANSACTIONS.fieldNames()))


def test_hot_keys_exact(spark):
    prods, tx, ptx = _data(spark)
    cf = {r.customer_id: r for r in feat.customer_features(tx.repartition(6), prods).collect()}
    hot = ptx[ptx.customer_id == 0]
    assert cf[0].total_purchases == len(hot)
    assert abs(cf[0].total_spent - hot.price.sum()) < 1e-6
    sec = (hot.product_id % 7).value_counts()
    assert cf[0].top_sec_no == min(v for v, n in sec.items() if n == sec.max())
    pf = {r.product_id: r for r in feat.product_price_stats(tx.repartition(6)).collect()}
    assert pf[7].popularity == int((ptx.product_id == 7).sum())


def test_hot_keys_plan_combines_map_side(spark):
    prods, tx, _ = _data(spark)
    plan = feat.customer_features(tx, prods)._jdf.queryExecution().executedPlan().toString()
    assert "partial_mode" in plan and "partial_count" in plan


def test_hot_customer_recommendations(spark):
    prods, tx, _ = _data(spark)
    cf = feat.customer_features(tx, prods)
    customers = spark.createDataFrame([(c, None, None, None, None, None, None) for c in range(200)], schemas.CUSTOMERS)
    cwf = feat.customers_with_features(customers, cf)
    pwf = feat.products_with_features(prods, feat.product_price_stats(tx))
    requests = customers.select("customer_id")
    ranked = recommend.ranked_candidates(requests, cwf, pwf)
    rows = ranked.where("customer_id = 0").orderBy("rank").collect()
    # the hot customer's list is that of scoring every product by hand
    from affinity.functions.pairs import FAVOURITES, match_flag
    from affinity.operators.model import AffinityScorer
    from pyspark.sql import functions as F

    scorer = AffinityScorer()
    every = cwf.where("customer_id = 0").crossJoin(pwf.drop("customer_id"))
    logit = scorer.logit(scorer.customer_term(F.col("total_purchases")), scorer.product_term(F.col("popularity")),
                         scorer.match_bonus({f.attribute: match_flag(F.col(f.top), F.col(f.attribute)) for f in FAVOURITES}))
    want = every.select("product_id", logit.alias("logit"), scorer.product_term(F.col("popularity")).alias("g")).where(
        "logit >= 0").orderBy(F.desc("logit"), F.desc("g"), "product_id").limit(12).collect()
    assert [(r.rank, r.product_id) for r in rows] == [(n + 1, r.product_id) for n, r in enumerate(want)] and rows
