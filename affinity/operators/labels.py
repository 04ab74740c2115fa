"""Labelled customer-product pairs: explode (E1), negative draws (N1), union.

Negative sampling draws, for every positive row, one product uniformly with
replacement from the product table. The draw is keyed on the row (see
``functions.draws``), so it is the same whatever the partitioning and on
task retry. Products are given dense numbers 0..n-1 without a global sort:
ids are spread over a fixed number of hash buckets, each bucket is numbered
by a window over that bucket only, and the bucket offsets (one row per
bucket, a bounded table) are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.draws import hash60, key_text, uniform_index
from affinity.functions.lists import parse_id_list
from affinity.session import stored
from affinity.sources.schemas import LABEL_COL

SEED = 73
#: buckets of the product numbering. The numbering, and with it every draw, depends on it: it is never derived from
#: the data. Raise it where a bucket (products / buckets) outgrows one task.
NUMBERING_BUCKETS = 1024


def explode_labels(lists: DataFrame) -> DataFrame:
    """Label lists -> one row per listed product.

    An empty list gives one row with a null product; repeated ids stay. The
    position in the list is kept as ``item_key``.
    """
    rest = [c for c in lists.columns if c != "list_product_id"]
    return (lists.select(*rest, F.posexplode_outer(parse_id_list(F.col("list_product_id"))).alias("pos", "product_id"))
            .select(*rest, "product_id", F.coalesce(F.col("pos").cast("string"), F.lit("")).alias("item_key")))


def number_products(products: DataFrame, buckets: int = NUMBERING_BUCKETS) -> DataFrame:
    """(product_id, product_idx) with product_idx a bijection onto 0..n-1."""
    ids = (products.select("product_id").where(F.col("product_id").isNotNull())
           .withColumn("bucket", F.pmod(hash60(F.col("product_id").cast("string")), F.lit(buckets))))
    per_bucket = ids.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_bucket"))
    # at most `buckets` rows: the single-partition running sum is bounded by the parameter
    offsets = per_bucket.select(
        "bucket",
        F.coalesce(F.sum("n_bucket").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("offset"))
    in_bucket = Window.partitionBy("bucket").orderBy("product_id")
    return (ids.join(F.broadcast(offsets), "bucket")
            .select("product_id", (F.col("offset") + F.row_number().over(in_bucket) - 1).alias("product_idx")))


def draw_key(seed: int) -> Column:
    return key_text(F.lit(str(seed)), F.col("time_date"), F.col("customer_id"),
                    F.col("product_id"), F.col("item_key"))


def with_draws(positives: DataFrame, products: DataFrame, seed: int = SEED) -> DataFrame:
    """Positive rows with ``product_idx``, the number of their uniformly drawn product."""
    n = products.where(F.col("product_id").isNotNull()).select(F.count(F.lit(1))).scalar()
    return positives.withColumn("product_idx", uniform_index(draw_key(seed), n))


def with_negatives(positives: DataFrame, products: DataFrame, seed: int = SEED,
                   buckets: int = NUMBERING_BUCKETS) -> DataFrame:
    """Positive rows with ``negative``: one uniformly drawn product each.

    Follows the reference: the draw may hit one of the customer's own
    positives. The draw joins the numbered products on the drawn index;
    indexes are uniform, so this join has no hot key.
    """
    numbered = number_products(products, buckets).withColumnRenamed("product_id", "negative")
    return with_draws(positives, products, seed).join(numbered, "product_idx").drop("product_idx")


def sample_negatives(positives: DataFrame, products: DataFrame, seed: int = SEED,
                     buckets: int = NUMBERING_BUCKETS) -> DataFrame:
    """The negative of every positive row, label 0."""
    keep = [c for c in positives.columns if c != "product_id"]
    out = with_negatives(positives, products, seed, buckets)
    return out.select(*keep, F.col("negative").alias("product_id")).withColumn(LABEL_COL, F.lit(0))


def labelled_pairs(positives: DataFrame, products: DataFrame, seed: int = SEED,
                   buckets: int = NUMBERING_BUCKETS) -> DataFrame:
    """Positives (label 1) and their negatives (label 0), bag union.

    One pass: every row gets its negative beside its positive and is then
    exploded into both, so the positives are computed once.
    """
    keep = [c for c in positives.columns if c != "product_id"]
    both = F.array(F.struct(F.col("product_id").alias("product_id"), F.lit(1).alias(LABEL_COL)),
                   F.struct(F.col("negative").alias("product_id"), F.lit(0).alias(LABEL_COL)))
    return (with_negatives(positives, products, seed, buckets)
            .select(*keep, F.inline(both)).select(*positives.columns, LABEL_COL))


def labelled_keys(drawn: DataFrame) -> DataFrame:
    """Rows of ``with_draws`` -> two rows each: (label 1, its product) and (label 0, the drawn number), both as ``product_key``.

    ``by_product_key`` has the products by the same two columns.
    """
    both = F.array(F.struct(F.col("product_id").alias("product_key"), F.lit(1).alias(LABEL_COL)),
                   F.struct(F.col("product_idx").alias("product_key"), F.lit(0).alias(LABEL_COL)))
    return (drawn.where(F.col("product_idx").isNotNull())
            .select(*[c for c in drawn.columns if c not in ("product_id", "product_idx")], F.inline(both)))


def by_product_key(products_wf: DataFrame, products: DataFrame, buckets: int = NUMBERING_BUCKETS) -> DataFrame:
    """Product rows once for label 1 under their id and once for label 0 under each of their numbers."""
    numbers = number_products(products, buckets).groupBy("product_id").agg(F.collect_list("product_idx").alias("numbers"))
    key = lambda k, label: F.struct(k.alias("product_key"), F.lit(label).alias(LABEL_COL))
    keys = F.concat(F.array(key(F.col("product_id"), 1)), F.coalesce(F.transform("numbers", lambda x: key(x, 0)), F.array()))
    return (products_wf.where(F.col("product_id").isNotNull()).join(numbers, "product_id", "left")
            .select(*products_wf.columns, F.inline(keys)))


# ----------------------------------------------------------------- strict negatives

ROW_KEY = ["split", "time_date", "customer_id", "item_key"]


def _who() -> dict[str, Column]:
    """The customer of a split as join keys that are never null, of columns that may be."""
    split, customer = F.col("split"), F.col("customer_id")
    return {"no_split": split.isNull(), "of_split": F.coalesce(split, F.lit("")),
            "no_customer": customer.isNull(), "of_customer": F.coalesce(customer, F.lit(0))}


WHO = ["no_split", "of_split", "no_customer", "of_customer"]


def sample_negatives_strict(positives: DataFrame, products: DataFrame, seed: int = SEED, per_round: int = 4,
                            buckets: int = NUMBERING_BUCKETS) -> DataFrame:
    """One negative per positive row that is never one of the customer's positives in that split.

    Exact rejection sampling: draw number j of a row is the keyed draw of
    (row, j); the negative is the product of the smallest j that is not a
    positive of the customer. The result does not depend on how draws are
    dealt into rounds. Every row makes its first draw in one pass, whose result
    is written once. Only rows whose draw was a positive go on: round i makes
    ``per_round * 2**i`` draws for the rows still unresolved, so a customer
    owning all products but one needs about log2(products) rounds, and no draw
    count is capped. The positives, the known products and each round's open
    rows are written to the shared checkpoint folder as Parquet. A customer who
    bought every product has no valid negative; such rows are kept with a null
    product. Rows with a null split, date, customer, product or item key are
    rows like any other: null customers of a split are one customer.
    """
    n = products.where(F.col("product_id").isNotNull()).count()
    negative = lambda df, c: df.select(*ROW_KEY, c.alias("product_id")).withColumn(LABEL_COL, F.lit(0))
    nothing = F.lit(None).cast("bigint")
    if not n:
        return negative(positives, nothing)
    numbered = stored(number_products(products, buckets).withColumnRenamed("product_id", "neg"), "numbered")
    rows = stored(positives.select(*ROW_KEY, "product_id"), "positives")
    known = stored(rows.where(F.col("product_id").isNotNull())
                   .select(*[c.alias(k) for k, c in _who().items()], F.col("product_id").alias("neg")).distinct(), "known")

    def drawn(df: DataFrame, j: Column) -> DataFrame:
        """``df`` with the product ``neg`` of draw ``j`` and ``taken``, true where the customer has bought it."""
        text = key_text(F.lit(str(seed)), F.col("time_date"), F.col("customer_id"), F.col("product_id"), F.col("item_key"), j)
        found = df.withColumn("product_idx", uniform_index(text, F.lit(n))).join(numbered, "product_idx")
        return (found.drop("product_idx").withColumns(_who()).join(known.withColumn("taken", F.lit(True)), [*WHO, "neg"], "left"))

    first = stored(drawn(rows, F.lit(0)).select(*ROW_KEY, "product_id", "neg", F.coalesce("taken", F.lit(False)).alias("taken")), "first-draws")
    out = negative(first.where(~F.col("taken")), F.col("neg"))
    # identical rows share their draws: each distinct one goes on once, with the number of its copies
    row = [*ROW_KEY, "product_id", "copies"]
    left = stored(first.where("taken").groupBy(*row[:-1]).agg(F.count("*").alias("copies")), "open")
    # products a customer can still be given: positives outside the product table don't narrow the choice
    whose = left.withColumns(_who())
    per_customer = (known.join(whose.select(*WHO).distinct(), WHO, "left_semi").join(numbered.select("neg"), "neg")
                    .groupBy(*WHO).agg(F.count(F.lit(1)).alias("n_known")).where(F.col("n_known") >= n))
    hits = [whose.join(per_customer, WHO, "left_semi").select(*row, nothing.alias("neg"))]
    left = stored(whose.join(per_customer, WHO, "left_anti").select(*row), "open")
    begin, draws_now = 1, per_round
    while left.take(1):
        tried = drawn(left.withColumn("j", F.explode(F.sequence(F.lit(begin), F.lit(begin + draws_now - 1)))), F.col("j"))
        done = stored(tried.groupBy(*row).agg(F.min_by("neg", F.when(F.col("taken").isNull(), F.col("j"))).alias("neg")), "draws")
        hits.append(done.where(F.col("neg").isNotNull()))
        left = done.where(F.col("neg").isNull()).select(*row)
        begin, draws_now = begin + draws_now, 2 * draws_now
    for hit in hits:
        copies = hit.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        out = out.unionByName(negative(copies, F.col("neg")))
    return out
