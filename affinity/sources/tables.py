"""The entity, transaction, label and request tables derived from the
TPC-H-style parquet inputs (``<sf_dir>/<table>.parquet``).

Each function returns a lazily planned DataFrame; Catalyst prunes the
parquet scan to the columns a query actually uses and pushes filters (such
as the label split date) into the scan. The attribute derivations below are
the fixture mapping: they give every reference column a deterministic value,
with nulls where the reference's missing-value rules need exercising.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Label lists dated before this day are the training split, the rest validation.
SPLIT_DATE = _dt.date(2001, 1, 1)


#: key values that are a multiple of it have no entity: transactions, labels and requests refer to ids that
#: no customer or product row has, so that every left join also misses
UNKNOWN_EVERY, UNKNOWN_OFFSET = 50, 1_000_000_000


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table.

    How a scan splits is a matter of the files and of ``spark.sql.files.*``.
    Files that cannot be split (one row group) can be dealt over a number of
    tasks that the caller names in ``affinity.input.partitions``; unset, the
    scan is left as it is.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get("affinity.input.partitions", None)
    return df.repartition(int(parts)) if parts else df


def _reference(col: Column | str) -> Column:
    """A key as transactions, labels and requests write it: some ids have no entity row."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col % UNKNOWN_EVERY == 0, col + UNKNOWN_OFFSET).otherwise(col)


def _price(col: str) -> Column:
    """NaN is a missing number."""
    return F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.alias("customer_id"),
        F.when(key % 3 == 0, F.lit(None)).otherwise(F.lit(1.0)).cast("double").alias("FN"),
        F.when(key % 4 == 1, F.lit(None)).otherwise(F.lit(1.0)).cast("double").alias("active_status"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "ACTIVE")
         .when(F.col("c_mktsegment") == "BUILDING", "PRE-CREATE")
         .when(F.col("c_mktsegment") == "FURNITURE", "LEFT CLUB")
         .when(F.col("c_mktsegment") == "HOUSEHOLD", "OTHER").alias("member_status"),
        F.when(F.col("c_nationkey") % 4 == 0, "NONE")
         .when(F.col("c_nationkey") % 4 == 1, "Regularly")
         .when(F.col("c_nationkey") % 4 == 2, "Monthly").alias("news_frequency"),
        F.when(key % 11 == 0, F.lit(None)).otherwise(16 + key % 60).cast("double").alias("age"),
        F.concat(F.lit("pc"), F.col("c_nationkey").cast("string")).alias("postal_code"),
    )


def _labelled(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    brand_no = F.substring(F.col("p_brand"), 7, 100).cast("bigint")
    return p.select(
        key.alias("product_id"),
        (key - key % 4).alias("product_code"),
        F.col("p_name").alias("prod_name"),
        (size % 12).cast("bigint").alias("prod_type_no"),
        _labelled("type ", size % 12).alias("prod_type_name"),
        F.when(key % 17 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("prod_group_name"),
        (key % 7).alias("graph_appearance_no"),
        _labelled("look ", key % 7).alias("graph_appearance_name"),
        (key % 11).alias("colour_group_code"),
        _labelled("colour ", key % 11).alias("colour_group_name"),
        F.when(key % 13 == 0, F.lit(None)).otherwise(key % 8).alias("perceived_colour_value_id"),
        _labelled("value ", key % 8).alias("perceived_colour_value_name"),
        (key % 5).alias("perceived_colour_master_id"),
        _labelled("master ", key % 5).alias("perceived_colour_master_name"),
        size.cast("bigint").alias("department_no"),
        _labelled("dept ", size).alias("department_name"),
        F.when(key % 2 == 0, F.lit(None)).otherwise(F.substring(F.col("p_type"), 1, 1)).alias("idx_code"),
        F.col("p_type").alias("idx_name"),
        (size % 4).cast("bigint").alias("idx_group_no"),
        _labelled("group ", size % 4).alias("idx_group_name"),
        brand_no.alias("sec_no"),
        F.col("p_brand").alias("sec_name"),
        (1 + brand_no % 12).alias("garment_group_no"),
        F.concat(F.lit("garment "), F.substring(F.col("p_brand"), 7, 100)).alias("garment_group_name"),
        F.col("p_name").alias("detail_desc"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders: what ``transactions`` and the items of ``label_items`` are made from."""
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    od = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def transactions(spark: SparkSession, sf_dir: str, sold: DataFrame | None = None) -> DataFrame:
    """One row per line item: (time_date, customer_id, product_id, price, sales_channel_id); ``sold`` are the ``sales`` if at hand."""
    return (sales(spark, sf_dir) if sold is None else sold).select(
        F.col("o_orderdate").cast("date").alias("time_date"),
        _reference("o_custkey").alias("customer_id"),
        _reference("l_partkey").alias("product_id"),
        _price("l_extendedprice").alias("price"),
        (1 + F.col("l_linenumber") % 2).cast("int").alias("sales_channel_id"),
    )


def label_items(spark: SparkSession, sf_dir: str, sold: DataFrame | None = None) -> DataFrame:
    """Positive label rows straight from the order tables, without building lists.

    A label list is everything a customer bought on one day. Exploding such a
    list gives one row per bought item, and an empty list (a day whose orders
    have no items) gives one row with a null product. The same rows come out
    of an inner order/line-item join plus the empty days, so no list is ever
    materialised:

    * items: line items inner-joined to their order. Both sides of an inner
      join can be split by AQE, so an order holding a large share of all line
      items does not end up in one task;
    * empty days: line items are counted per order (combined map-side), the
      one-row-per-order counts are joined to the orders, and days whose count
      sum is 0 give a null-product row.

    ``item_key`` (order, line number, part, supplier) names the item within
    its customer-day and keys the negative draw; fully identical input lines
    share it (and their draw).

    Columns: split, time_date, customer_id, product_id, item_key. ``sold`` are the ``sales`` if at hand.
    """
    od = _read(spark, sf_dir, "orders").select(
        "o_orderkey", _reference("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("time_date"))
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    split = F.when(F.col("time_date") < F.lit(SPLIT_DATE), "train").otherwise("val")
    found = (sales(spark, sf_dir) if sold is None else sold).where(F.col("l_partkey").isNotNull()).withColumns(
        {"customer_id": _reference("o_custkey"), "time_date": F.col("o_orderdate").cast("date")})
    items = found.select(
        split.alias("split"), "time_date", "customer_id",
        _reference("l_partkey").alias("product_id"),
        F.concat_ws(":", *[F.col(c).cast("string") for c in ("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
        .alias("item_key"),
    )
    per_order = li.groupBy("l_orderkey").agg(F.count("l_partkey").alias("n_items"))
    empty_days = (
        od.join(per_order, od.o_orderkey == per_order.l_orderkey, "left")
        .groupBy("time_date", "customer_id")
        .agg(F.sum(F.coalesce(F.col("n_items"), F.lit(0))).alias("n_items"))
        .where(F.col("n_items") == 0)
        .select(split.alias("split"), "time_date", "customer_id",
                F.lit(None).cast("bigint").alias("product_id"), F.lit("").alias("item_key"))
    )
    return items.unionByName(empty_days)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers to score: one row per customer, some under an id that no customer has, and some asked twice."""
    key = F.col("c_custkey")
    times = F.when(key % 40 == 1, 2).otherwise(1)
    return _read(spark, sf_dir, "customer").select(
        _reference(key).alias("customer_id"), F.explode(F.sequence(F.lit(1), times)).alias("n")).drop("n")


def assert_unique(df: DataFrame, key: str, name: str) -> None:
    """Raise if ``key`` repeats in an entity table.

    Feature joins attach one row per entity; a repeated id would multiply
    pair rows. The check is one aggregate with map-side combining; only the
    first few offending ids (a bounded sample for the message) reach the
    driver.
    """
    dups = df.groupBy(key).count().where(F.col("count") > 1).select(key).limit(5).collect()
    if dups:
        raise ValueError(f"{name}: {key} is not unique, e.g. {[r[0] for r in dups]}")
