import math
import random

import pytest

from affinity.functions.pairs import FAVOURITES
from affinity.operators import recommend
from affinity.operators.model import AffinityScorer
from affinity.plans import catalog
from affinity.sources import sinks

from conftest import SF_SMALL

TOPS = [f.top for f in FAVOURITES]
ATTRS = [f.attribute for f in FAVOURITES]
TEXT = {"prod_group_name", "idx_code"}


def _fixture(spark, seed, n_cust=40, n_prod=60, domain=3):
    rng = random.Random(seed)

    def val(attr):
        if rng.random() < 0.15:
            return None
        v = rng.randrange(domain)
        return f"v{v}" if attr in TEXT else v

    cust = [(c, rng.choice([None, 0, 1, 5, 40]), *[val(a) for a in ATTRS]) for c in range(n_cust)]
    prod = [(p, *[val(a) for a in ATTRS], rng.choice([None, 0, 1, 2, 3, 10])) for p in range(n_prod)]
    ctype = ", ".join(f"{f.top} {'string' if f.attribute in TEXT else 'bigint'}" for f in FAVOURITES)
    ptype = ", ".join(f"{a} {'string' if a in TEXT else 'bigint'}" for a in ATTRS)
    cdf = spark.createDataFrame(cust, f"customer_id bigint, total_purchases bigint, {ctype}")
    pdf = spark.createDataFrame(prod, f"product_id bigint, {ptype}, popularity bigint")
    return cust, prod, cdf, pdf


def _brute_force(cust, prod, scorer, k):
    """Score every pair in Python with the same rounding and order."""
    def r9(x):
        return round(x, 9)

    out = {}
    for c in cust:
        cid, tp, tops = c[0], c[1], c[2:]
        ct = r9(scorer.intercept + scorer.frequency_weight * math.log(1.0 + (tp or 0)))
        scored = []
        for p in prod:
            pid, attrs, pop = p[0], p[1:-1], p[-1]
            g = r9(scorer.popularity_weight * math.log(1.0 + (pop or 0)))
            bonus = max([0.0] + [scorer.match_weights[a] for a, t, v in zip(ATTRS, tops, attrs)
                                 if t is not None and v is not None and t == v])
            lg = r9(ct + g + bonus)
            if lg >= 0:
                scored.append((-lg, -g, pid))
        out[cid] = [pid for _, _, pid in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("seed,k", [(1, 3), (2, 5), (3, 12)])
def test_candidates_give_the_exact_top_k(spark, seed, k):
    scorer = AffinityScorer(intercept=-1.0)
    cust, prod, cdf, pdf = _fixture(spark, seed)
    requests = cdf.select("customer_id")
    ranked = recommend.ranked_candidates(requests, cdf, pdf, scorer, k=k)
    got = {r.customer_id: [x for x in r.list_product_id] for r in recommend.recommendations(requests, ranked).collect()}
    want = _brute_force(cust, prod, scorer, k)
    assert got == want
    assert any(len(v) == k for v in want.values())   # the limit is exercised


def test_top_k_without_broadcasts_is_the_same(spark):
    i = catalog.Inputs(spark, SF_SMALL)
    a = sorted(map(tuple, i.ranked().collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = catalog.Inputs(spark, SF_SMALL).ranked()
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, df.collect())) == a
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unknown_and_repeated_requests_keep_their_rows(spark):
    scorer = AffinityScorer(intercept=-50.0)  # nothing reaches 0.5
    cust, prod, cdf, pdf = _fixture(spark, 4)
    requests = spark.createDataFrame([(1,), (1,), (999,)], "customer_id bigint")
    recs = recommend.recommendations(requests, recommend.ranked_candidates(requests, cdf, pdf, scorer)).collect()
    assert sorted((r.customer_id, tuple(r.list_product_id)) for r in recs) == [(1, ()), (1, ()), (999, ())]


def test_probability_exactly_half_is_eligible(spark):
    scorer = AffinityScorer(intercept=0.0, frequency_weight=0.0, popularity_weight=0.0,
                            match_weights={a: 0.0 for a in ATTRS})
    cust, prod, cdf, pdf = _fixture(spark, 5, n_cust=3, n_prod=20)
    ranked = recommend.ranked_candidates(cdf.select("customer_id"), cdf, pdf, scorer).collect()
    assert {r.probability for r in ranked} == {0.5}
    assert len(ranked) == 3 * 12    # more than 12 eligible -> 12, ties by product id
    assert sorted(r.product_id for r in ranked if r.customer_id == 0) == list(range(12))


def test_submission_round_trip(spark):
    recs = spark.createDataFrame([(1, [3, 20, 7]), (2, [])], "customer_id bigint, list_product_id array<bigint>")
    lines = recommend.prediction_lines(recs)
    assert sorted(r.line for r in lines.collect()) == ["1,[3, 20, 7]", "2,[]"]
    sub = sorted(tuple(r) for r in recommend.parse_prediction_lines(lines).collect())
    assert sub == [(1, "[3 20 7]"), (2, "[]")] == sorted(tuple(r) for r in recommend.submission(recs).collect())


def test_recommendation_plan_has_no_pair_enumeration(spark):
    df = catalog.queries()["recommendations"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython"):
        assert bad not in plan
    assert "WindowGroupLimit" in plan


def test_no_exchange_between_fan_out_and_ranking(spark):
    """The candidate join, scoring and ranking window run on the request partitioning."""
    i = catalog.Inputs(spark, SF_SMALL)
    ranked = recommend.ranked_candidates(i.requests, i.customers_wf(), i.products_wf())
    lines = ranked._jdf.queryExecution().executedPlan().toString().splitlines()
    window = next(n for n, line in enumerate(lines) if "Window [dense_rank" in line)
    fan_out = next(n for n, line in enumerate(lines) if n > window and "Generate explode" in line)
    assert not any("Exchange" in line for line in lines[window:fan_out])
    assert any("REPARTITION_BY_NUM" in line and "customer_id" in line for line in lines[fan_out:])


def test_prediction_lines_with_headers_and_bad_lines(spark, tmp_path):
    recs = spark.createDataFrame([(1, [3, 4]), (2, []), (3, [5])], "customer_id bigint, list_product_id array<bigint>").repartition(2)
    path = str(tmp_path / "predictions")
    sinks.write_prediction_lines(recommend.prediction_lines(recs), path, recommend.PREDICTIONS_HEADER)
    lines = spark.read.text(path).toDF("line")
    assert lines.where("line = 'customer_id, list_product_id'").count() >= 1 and lines.where("line = '1,[3, 4]'").count() == 1
    assert sorted(map(tuple, recommend.parse_prediction_lines(lines).collect())) == [(1, "[3 4]"), (2, "[]"), (3, "[5]")]
    assert recommend.unparsed_prediction_lines(lines).count() == 0
    odd = spark.createDataFrame([("x7,[1]",), ("8",), (None,), ("9,[1, 2]",)], "line string")
    assert {r.line for r in recommend.unparsed_prediction_lines(odd).collect()} == {"x7,[1]", "8", None}
    assert [r.list_product_id for r in recommend.parse_prediction_lines(odd).where("customer_id = 9").collect()] == ["[1 2]"]


def test_candidate_attributes_are_text_before_they_fan_out(spark):
    """Lists hold attributes as they are compared, so that no candidate row casts them."""
    _, _, cdf, pdf = _fixture(spark, 5)
    items = recommend.product_candidates(pdf, AffinityScorer()).schema["items"].dataType.elementType
    assert {items[a].dataType.typeName() for a in ATTRS} == {"string"}


def test_bonus_stops_at_the_heaviest_match(spark):
    from pyspark.sql import functions as F

    scorer = AffinityScorer(match_weights={"a": 0.2, "b": 0.9, "c": 0.0})
    rows = [(x, y, z) for x in (True, False, None) for y in (True, False, None) for z in (True, False, None)]
    flags = spark.createDataFrame(rows, "a boolean, b boolean, c boolean")
    got = flags.select("*", scorer.match_bonus({c: F.col(c) for c in "abc"}).alias("bonus")).collect()
    assert all(r.bonus == max([0.0] + [w for c, w in scorer.match_weights.items() if r[c]]) for r in got)
