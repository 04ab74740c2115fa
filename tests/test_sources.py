import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from affinity.operators import labels
from affinity.plans import catalog
from affinity.sources import files, sinks


def _write(text):
    d = tempfile.mkdtemp(prefix="affinity-test-")
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_customer_csv_missing_tokens(spark):
    p = _write("customer_id,FN,active_status,member_status,news_frequency,age,postal_code\n"
               "1,1.0,,ACTIVE,NONE,NaN,pc1\n"
               "2,NA,1,N/A,None,31,null\n"
               "3,nan,abc,LEFT CLUB,Monthly,,x\n")
    got = {r.customer_id: r for r in files.read_customers(spark, p).collect()}
    assert got[1].active_status is None and got[1].age is None and got[1].news_frequency == "NONE"
    assert got[2].FN is None and got[2].member_status is None and got[2].news_frequency is None
    assert got[2].postal_code is None and got[2].age == 31.0
    assert got[3].FN is None and got[3].active_status is None   # bad number -> NULL, no job failure


def test_label_list_csv_to_positives(spark):
    p = _write("time_date,customer_id,list_product_id\n2020-09-01,7,[108 2051 7]\n2020-09-02,8,[]\n")
    lists = files.read_label_lists(spark, p, "train")
    rows = sorted(((r.customer_id, r.product_id, r.item_key, r.split) for r in labels.explode_labels(lists).collect()),
                  key=repr)
    assert rows == sorted([(7, 108, "0", "train"), (7, 2051, "1", "train"), (7, 7, "2", "train"),
                           (8, None, "", "train")], key=repr)
    assert lists.collect()[0].time_date == dt.date(2020, 9, 1)


def test_transactions_and_requests_csv(spark):
    p = _write("time_date,customer_id,product_id,price,sales_channel_id\n2020-09-01,1,2,0.05,2\n2020-09-02,1,3,,1\n")
    tx = files.read_transactions(spark, p).collect()
    assert tx[0].price == 0.05 and tx[1].price is None and tx[0].sales_channel_id == 2
    q = _write("customer_id\n5\n6\n")
    assert [r.customer_id for r in files.read_requests(spark, q).collect()] == [5, 6]


def test_sinks_round_trip(spark):
    out = tempfile.mkdtemp(prefix="affinity-test-")
    sub = spark.createDataFrame([(1, "[3 4]"), (2, "[]")], "customer_id bigint, list_product_id string")
    sinks.write_submission(sub, os.path.join(out, "submission"))
    back = spark.read.option("header", True).csv(os.path.join(out, "submission"))
    assert sorted((r.customer_id, r.list_product_id) for r in back.collect()) == [("1", "[3 4]"), ("2", "[]")]
    recs = spark.createDataFrame([(1, [3, 4])], "customer_id bigint, list_product_id array<bigint>")
    sinks.write_predictions(recs, os.path.join(out, "pred"))
    assert spark.read.parquet(os.path.join(out, "pred")).collect()[0].list_product_id == [3, 4]
    rep = spark.createDataFrame([("val", "auc_roc", 0.7)], "split string, metric string, value double")
    sinks.write_metrics(rep, os.path.join(out, "metrics"))
    assert spark.read.parquet(os.path.join(out, "metrics")).count() == 1


def test_entity_keys_must_be_unique(spark):
    import pytest

    from affinity.sources import tables

    ok = spark.createDataFrame([(1,), (2,)], "customer_id bigint")
    tables.assert_unique(ok, "customer_id", "customers")
    bad = spark.createDataFrame([(1,), (2,), (2,)], "customer_id bigint")
    with pytest.raises(ValueError, match="not unique"):
        tables.assert_unique(bad, "customer_id", "customers")


def test_csv_quotes_line_breaks_and_column_order(spark):
    p = _write('postal_code,age,customer_id,extra,FN,active_status,member_status,news_frequency\n'
               '"a ""q"", b",33,1,x,1,,"LEFT\nCLUB",NONE\n'
               'pc2,,2,y,,,,\n')
    got = {r.customer_id: r for r in files.read_customers(spark, p).collect()}
    assert len(got) == 2 and got[1].postal_code == 'a "q", b' and got[1].age == 33.0
    assert got[1].member_status == "LEFT\nCLUB" and got[1].FN == 1.0 and got[2].postal_code == "pc2"


def test_csv_missing_column_and_bad_values_are_errors(spark):
    import pytest

    from affinity.sources import schemas

    p = _write("customer_id,FN\n1,1\n")
    with pytest.raises(ValueError, match="no column active_status"):
        files.read_customers(spark, p)
    q = _write("time_date,customer_id,product_id,price,sales_channel_id\n2020-09-01,1,x7,0.05,2\n2020-13-01,1,3,NA,1\n")
    with pytest.raises(ValueError, match="product_id.*1"):
        files.read_typed_csv(spark, q, schemas.TRANSACTIONS, strict=True)
    bad = files.bad_values(files.read_csv_text(spark, q, schemas.TRANSACTIONS), schemas.TRANSACTIONS).first()
    assert (bad.time_date, bad.product_id, bad.price) == (1, 1, 0)


def test_prices_are_not_cut_and_nan_is_missing(spark):
    from pyspark.sql import functions as F

    from affinity.operators import features as feat
    from affinity.sources import schemas, tables

    d = dt.date(2020, 1, 1)
    fine = spark.createDataFrame([(d, 1, 1, 0.050830508474576264, 1), (d, 1, 1, 1e-11, 1), (d, 2, 1, 1e30, 1)], schemas.TRANSACTIONS)
    got = {r.customer_id: r.total_spent for r in feat.customer_rfm(fine).collect()}
    assert got == {1: 0.050830508474576264 + 1e-11, 2: 1e30}
    raw = spark.createDataFrame([(2.0,), (float("nan"),), (4.0,)], "p double")
    tx = raw.select(F.lit(d).alias("time_date"), F.lit(1).cast("bigint").alias("customer_id"),
                    F.lit(5).cast("bigint").alias("product_id"), tables._price("p").alias("price"))
    r = feat.product_price_stats(tx).first()
    assert (r.average_price, round(r.price_std, 3), r.popularity) == (3.0, 1.414, 3)


def test_session_keeps_submitted_sizes(spark):
    from affinity.session import get_spark

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4000")
        assert get_spark("again").conf.get("spark.sql.shuffle.partitions") == "4000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_csv_files_of_a_folder_may_order_their_columns_differently(spark, tmp_path):
    import gzip

    import pytest

    (tmp_path / "a.csv").write_text("time_date,customer_id,product_id,price,sales_channel_id\n2020-01-01,1,10,0.5,2\n")
    (tmp_path / "b.csv").write_text("customer_id,product_id,time_date,\"price\",sales_channel_id,more\n7,70,2020-02-02,0.25,1,x\n8,80,2020-02-03,NA,1,y\n")
    (tmp_path / "c.csv").write_text("")
    with gzip.open(tmp_path / "d.csv.gz", "wt") as f:
        f.write("product_id,time_date,customer_id,price,sales_channel_id\n90,2020-03-03,9,1.5,2\n")
    got = sorted((str(r.time_date), r.customer_id, r.product_id, r.price) for r in files.read_transactions(spark, str(tmp_path)).collect())
    assert got == [("2020-01-01", 1, 10, 0.5), ("2020-02-02", 7, 70, 0.25), ("2020-02-03", 8, 80, None), ("2020-03-03", 9, 90, 1.5)]
    (tmp_path / "e.csv").write_text("customer_id,price\n1,2\n")
    with pytest.raises(ValueError, match="e.csv: no column time_date"):
        files.read_transactions(spark, str(tmp_path))


def test_type_map_gives_schemas_merges_and_clashes(spark, tmp_path):
    import json

    import pytest
    from pyspark.sql import types as T

    from affinity.sources import schemas
    from affinity.sources.type_map import asserted, merged, read_type_map

    said = {"src_entity": {f.name: "category" if f.name != "age" else "float64" for f in schemas.CUSTOMERS[1:]},
            "tar_entity": {f.name: {"bigint": "Int64"}.get(f.dataType.simpleString(), "category") for f in schemas.PRODUCTS[1:]} | {
                "idx_group_no": "category", "garment_group_no": "category"},
            "pkeys": {"customer_id": "Int64", "product_id": "Int64"}}
    path = tmp_path / "types.json"
    path.write_text(json.dumps(said, indent=2))
    assert read_type_map(spark, str(path)) == (schemas.CUSTOMERS, schemas.PRODUCTS)
    more = T.StructType([T.StructField("total_spent", T.DoubleType()), T.StructField("age", T.DoubleType())])
    assert merged(schemas.CUSTOMERS, more).names == schemas.CUSTOMERS.names + ["total_spent"]
    with pytest.raises(ValueError, match="age .double, string"):
        merged(schemas.CUSTOMERS, T.StructType([T.StructField("age", T.StringType())]))
    df = spark.createDataFrame([], schemas.CUSTOMERS)
    assert asserted(df, schemas.CUSTOMERS, "customers") is df
    for wrong in (df.drop("age"), df.select(*reversed(df.columns)), df.withColumn("age", F.lit("x"))):
        with pytest.raises(ValueError, match="customers: "):
            asserted(wrong, schemas.CUSTOMERS, "customers")
    # the scans take the map's columns and types
    path.write_text(json.dumps(said | {"src_entity": {"age": "Int64", "shoe": "category"}}))
    (tmp_path / "c.csv").write_text("shoe,customer_id,age\n43,1,30\nNA,2,x\n")
    i = catalog.FileInputs(spark, {"types": str(path), "customers": str(tmp_path / "c.csv")})
    assert sorted(map(tuple, i.customers.collect())) == [(1, 30, "43"), (2, None, None)]
    for broken, says in ((said | {"src_entity": {"age": "complex"}}, "unknown type"), ({"pkeys": {}}, "needs src_entity"),
                         (said | {"src_entity": {"customer_id": "Int64"}}, "also a column")):
        path.write_text(json.dumps(broken))
        with pytest.raises(ValueError, match=says):
            read_type_map(spark, str(path))


def test_large_csv_files_are_read_by_many_tasks(spark, tmp_path):
    """Quoted commas, quotes and odd spaces, but no quoted line break: ranges of one file, the same rows."""
    path = tmp_path / "c.csv"
    lines = [f'{i},1,,ACTIVE,NONE,{i % 90},"code ""{i}"", x"' for i in range(60_000)]
    path.write_text("customer_id,FN,active_status,member_status,news_frequency,age,postal_code\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
        df = files.read_customers(spark, str(path))
        assert df.rdd.getNumPartitions() >= 8
        assert df.count() == 60_000 and df.where("postal_code <> concat('code \"', customer_id, '\", x')").count() == 0
        path.write_text(path.read_text() + '70000,1,,ACTIVE,NONE,5,"two\nlines"\n')
        more = files.read_customers(spark, str(path))
        assert more.rdd.getNumPartitions() > 1 and more.count() == 60_001
        assert more.where("customer_id = 70000").first().postal_code == "two\nlines"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_line_breaks_in_ranges_equal_the_whole_file_reader(spark, tmp_path, monkeypatch):
    """Ranges of a few bytes: records over many ranges, texts of quotes and line breaks only, several files."""
    import random

    from affinity.session import stored
    from affinity.sources import csv_ranges
    from affinity.sources.csv_ranges import csv_records

    rng = random.Random(4)
    pieces = ["a", "b c", ",", "\n", "\n\n", '"', '""', "é", "", "1", "\n,\n", " "]
    quoted = lambda t: '"' + t.replace('"', '""') + '"'
    schema = "customer_id string, note string, code string"
    from pyspark.sql import types as T
    columns = T.StructType([T.StructField(n, T.StringType()) for n in ("note", "customer_id")])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    ranges = []

    def cut(df, tag):  # only the files are cut into such small ranges
        ranges.append(df.rdd.getNumPartitions())
        kept = stored(df, tag)
        for k, v in before.items():
            spark.conf.set(k, v)
        return kept

    monkeypatch.setattr(csv_ranges, "stored", cut)
    try:
        for end, size in (("\n", 90), ("\r\n", 400), ("\n", 1 << 20)):
            folder = tmp_path / f"{len(end)}-{size}"
            folder.mkdir()
            for f in range(3):
                rows = [(f"{f}-{i}", "".join(rng.choices(pieces, k=rng.choice((0, 1, 3, 8, 60)))), rng.choice(("", "x", '""', '"q,"')))
                        for i in range(30)]
                text = end.join(["customer_id,note,code", *(f"{a},{quoted(b)},{c}" for a, b, c in rows)]) + end * (f % 2)
                (folder / f"{f}.csv").write_bytes(text.encode())
            names = [str(folder / f"{f}.csv") for f in range(3)]
            for k in before:
                spark.conf.set(k, str(size))
            assert csv_records(spark, names) is not None
            for k in before:
                spark.conf.set(k, str(size))
            got = files.read_csv_text(spark, str(folder), columns)
            want = spark.read.schema(schema).options(header=True, quote='"', escape='"', multiLine=True, emptyValue="").csv(names)
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select(*columns.names).collect()), key=repr)
            assert got.count() == 90
        assert ranges[0] > 20 and ranges[2] > 6
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_quotes_that_follow_no_rule_are_left_to_the_whole_file_reader(spark, tmp_path):
    from pyspark.sql import types as T

    from affinity.sources.csv_ranges import csv_records

    columns = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b")])
    for text, want in (('a,b\n1,5" pipe\n2,6" pipe\n', [("1", '5" pipe'), ("2", '6" pipe')]),
                       ('a,b\r1,"x\ry"\r2,"z\n"\r', [("1", "x\ny"), ("2", "z\n")])):
        path = tmp_path / "odd.csv"
        path.write_bytes(text.encode())
        assert csv_records(spark, [str(path)]) is None
        got = files.read_csv_text(spark, str(path), columns)
        assert sorted(map(tuple, got.collect())) == want
    path.write_bytes(b'a,b\n1,"x\ny"\n')
    assert [tuple(r) for r in files.read_csv_text(spark, str(path), columns).collect()] == [("1", "x\ny")]
