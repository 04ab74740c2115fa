import __spark_entry__ as entry
from affinity.plans import catalog, oracle
from affinity.sources import tables

ROWS_ONLY = {"gbt_scores", "gbt_evaluation_report", "random_search_report", "halving_search_report", "recommendations_trees", "boosted_report"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_id", "list_product_id"]
    assert df.count() == tables.requests(spark, "/root/testdata/sf0.001").count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    qs, sql = catalog.queries(), oracle.queries()
    assert set(sql) <= set(qs)
    assert set(qs) <= set(entry.queries()) and set(sql) <= set(entry.oracle_sql())
    assert set(qs) - set(sql) == ROWS_ONLY


def test_no_python_udfs_in_plans(spark):
    for name, q in catalog.queries().items():
        if name in ROWS_ONLY:
            continue
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
