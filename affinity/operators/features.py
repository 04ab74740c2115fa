"""Customer and product features.

Shape of the work at scale
--------------------------
* Customer features are ONE aggregate keyed by customer: recency, frequency,
  spend and the eleven favourite values (``mode`` with the smallest value on
  ties) are computed together. The narrow rows are hash-partitioned by
  customer first and counted where they arrive: past a shuffled product join
  a customer's rows lie all over, and a count per (customer, attribute, value)
  of every map task takes several times the bytes of the rows it counts. A
  task streams its customers' rows (sorting spills), its counts are bounded
  by the attributes' domains; a hot customer's rows are one task's work.
* Product features are ONE aggregate keyed by product: price mean / std,
  popularity and buyer-demographic mean / std. Its rows, too, go to their product
  before they are aggregated: the states of twelve means and deviations of a
  product take several times the bytes of a purchase, and past the customer join
  a task has few purchases of each product.
* Product attributes travel to the customers, demographics to the products packed (``functions.packing``).
* The product attribute table and the encoded customer table are joined with
  the columns needed only. No hint is given: Spark broadcasts a side whose
  measured bytes are within ``spark.sql.autoBroadcastJoinThreshold`` and
  otherwise shuffles, where AQE splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.encode import encode_customers
from affinity.functions.packing import folded, unfolded
from affinity.functions.pairs import DEMOGRAPHICS, FAVOURITES, unit_if_zero

ATTRIBUTES = [f.attribute for f in FAVOURITES]
TOP_COLUMNS = [f.top for f in FAVOURITES]
CUSTOMER_FEATURE_COLUMNS = ["last_purchase_date", "first_purchase_date", "total_purchases", "total_spent"] + TOP_COLUMNS
PRODUCT_FEATURE_COLUMNS = ["average_price", "price_std", "popularity"] + [
    c for d in DEMOGRAPHICS for c in (d.mean, d.std)]
DEMOGRAPHIC_COLUMNS = [d.customer_col for d in DEMOGRAPHICS]


def product_attributes(products: DataFrame) -> DataFrame:
    return products.select("product_id", *ATTRIBUTES)


def expand_transactions(tx: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Transactions with encoded customer and raw product columns."""
    return tx.join(encode_customers(customers), "customer_id", "left").join(products, "product_id", "left")


def _known_customers(tx: DataFrame) -> DataFrame:
    # grouping drops a missing key, as the reference's grouping does
    return tx.where(F.col("customer_id").isNotNull())


def _purchases(tx: DataFrame, products: DataFrame, *columns: str) -> DataFrame:
    """Known customers' purchases with the product attributes, a customer's rows in one partition."""
    txp = _known_customers(tx).select("customer_id", "product_id", *columns).join(
        folded(product_attributes(products), ATTRIBUTES), "product_id", "left")
    return unfolded(txp.drop("product_id").repartition("customer_id"), ATTRIBUTES)


def attribute_counts(tx: DataFrame, products: DataFrame) -> DataFrame:
    """Purchases per (customer, attribute, value), long form, values as text (A1)."""
    # exploded, not unpivoted: an explode keeps the partitioning by customer, so the count needs no further exchange
    pairs = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in ATTRIBUTES])
    longf = _purchases(tx, products).select("customer_id", F.inline(pairs))
    return (longf.where(F.col("value").isNotNull())
            .groupBy("customer_id", "attribute", "value").agg(F.count(F.lit(1)).alias("cnt")))


def favourites_rownumber(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Favourite value per (customer, attribute) by ranking the counts.

    Ties go to the smallest value, compared numerically for numeric
    attributes. The window partitions are (customer, attribute) groups of
    distinct values, so their size is bounded by the attribute's domain.
    """
    numeric = [f.name for f in products.schema.fields
               if f.name in ATTRIBUTES and f.dataType.typeName() in ("long", "integer")]
    value_num = F.when(F.col("attribute").isin(numeric), F.col("value").cast("bigint"))
    w = Window.partitionBy("customer_id", "attribute").orderBy(
        F.col("cnt").desc(), value_num.asc_nulls_last(), F.col("value").asc())
    return (counts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1)
            .select("customer_id", "attribute", F.col("value").alias("top_value")))


def _with_closed_domain(df: DataFrame, products: DataFrame) -> DataFrame:
    """Category attributes: a customer with no non-missing value gets the domain minimum (A2z).

    The minimum is a one-row scalar subquery over the product table.
    """
    cols = []
    for f in FAVOURITES:
        c = F.col(f.top)
        if f.closed_domain:
            c = F.coalesce(c, products.select(F.min(f.attribute)).scalar())
        cols.append(c.alias(f.top))
    return df.select(*[c for c in df.columns if c not in TOP_COLUMNS], *cols)


def favourites(tx: DataFrame, products: DataFrame, closed_domain: bool = True) -> DataFrame:
    """Favourite value of each attribute per customer (A2, with A2z unless disabled)."""
    out = _purchases(tx, products).groupBy("customer_id").agg(*[F.mode(f.attribute, True).alias(f.top) for f in FAVOURITES])
    return _with_closed_domain(out, products) if closed_domain else out


def customer_rfm(tx: DataFrame) -> DataFrame:
    """Recency, first purchase, frequency and spend per customer (A3)."""
    return _known_customers(tx).groupBy("customer_id").agg(*_rfm_aggs())


def _rfm_aggs():
    return [
        F.max("time_date").alias("last_purchase_date"),
        F.min("time_date").alias("first_purchase_date"),
        F.count(F.lit(1)).alias("total_purchases"),
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("total_spent"),
    ]


def customer_features(tx: DataFrame, products: DataFrame) -> DataFrame:
    """All customer features in one customer-keyed aggregate (Q1; J4 folded away)."""
    out = _purchases(tx, products, "time_date", "price").groupBy("customer_id").agg(
        *_rfm_aggs(), *[F.mode(f.attribute, True).alias(f.top) for f in FAVOURITES])
    return _with_closed_domain(out, products).select("customer_id", *CUSTOMER_FEATURE_COLUMNS)


def product_price_stats(tx: DataFrame) -> DataFrame:
    """Price mean, price std and popularity per product (A5)."""
    return (tx.where(F.col("product_id").isNotNull()).groupBy("product_id")
            .agg(*_price_aggs()))


def _price_aggs():
    return [
        F.avg("price").alias("average_price"),
        F.stddev_samp("price").alias("price_std"),
        F.count(F.lit(1)).alias("popularity"),
    ]


def _buyer_aggs():
    out = []
    for d in DEMOGRAPHICS:
        out += [F.avg(d.customer_col).alias(d.mean), F.stddev_samp(d.customer_col).alias(d.std)]
    return out


def _buyers(tx: DataFrame, customers: DataFrame) -> DataFrame:
    enc = encode_customers(customers).select("customer_id", *DEMOGRAPHIC_COLUMNS)
    bought = tx.where(F.col("product_id").isNotNull()).select("product_id", "customer_id", "price").join(
        folded(enc, DEMOGRAPHIC_COLUMNS), "customer_id", "left").drop("customer_id")
    return unfolded(bought.repartition("product_id"), DEMOGRAPHIC_COLUMNS)


def _unit_stds(df: DataFrame) -> DataFrame:
    stds = {d.std for d in DEMOGRAPHICS}
    return df.select(*[unit_if_zero(F.col(c)).alias(c) if c in stds else F.col(c) for c in df.columns])


def product_buyer_stats(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """Mean and sample std of buyer demographics per product, zero std -> 1."""
    return _unit_stds(_buyers(tx, customers).groupBy("product_id").agg(*_buyer_aggs()))


def product_features(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """All product features in one product-keyed aggregate (Q2; J5 folded away)."""
    out = _buyers(tx, customers).groupBy("product_id").agg(*_price_aggs(), *_buyer_aggs())
    return _unit_stds(out).select("product_id", *PRODUCT_FEATURE_COLUMNS)


def customers_with_features(customers: DataFrame, cust_features: DataFrame) -> DataFrame:
    """Encoded customers left-joined to their features (J3); no transactions -> null features."""
    return encode_customers(customers).join(cust_features, "customer_id", "left")


def products_with_features(products: DataFrame, prod_features: DataFrame) -> DataFrame:
    """Products left-joined to their features."""
    return products.join(prod_features, "product_id", "left")
