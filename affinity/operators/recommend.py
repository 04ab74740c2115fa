"""Top-k recommendations per requested customer.

The reference scores every requested customer against every product and
keeps the 12 best with probability >= 0.5. Enumerating requests x products
grows as a product of two tables, so it is not done here. For the affinity
scorer the same top-k is found exactly from a bounded candidate set:

    logit(c, p) = c(c) + g(p) + max_k w_k * [fav_k(c) = attr_k(p)],  w_k >= 0

Let p be in c's true top-k. If p matches none of c's favourites, at least
k products with a better-or-equal (g, id) would outrank it unless p is in
the global top-k by g. If p's best matching attribute is k*, any product
sharing that attribute value with a better (g, id) scores at least as high,
so p is among the top-k by g of products with attr_k* = fav_k*(c). Hence the
candidates are: the global top-k by g, plus for each attribute the top-k by
g among products carrying the customer's favourite value. That is at most
k * (1 + 11) candidates per customer: the customer's (attribute, value) keys
are equi-joined to a table of per-value top-k lists, one row a list, and the
global list (k rows at most) is part of the plan.
Ordering is (logit desc, g desc, product_id asc) throughout, which makes
the argument hold with ties too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.lists import format_id_list, parse_id_list
from affinity.functions.pairs import FAVOURITES, match_flag
from affinity.operators.model import DECIMALS, AffinityScorer, probability
from affinity.session import stored

TOP_K = 12
GLOBAL = "*"  # attribute / value key of the global top-k list
ATTRIBUTES = [f.attribute for f in FAVOURITES]
TOPS = [f.top for f in FAVOURITES]


def product_candidates(products_wf: DataFrame, scorer: AffinityScorer, k: int = TOP_K) -> DataFrame:
    """Per (attribute, value): the k best products by (g desc, id asc); plus the global k best.

    Columns: attribute, value and ``items``, an array of k structs at most
    with product_id, the product's 11 attributes as text (each of the many
    candidate rows compares them, none casts them) and g. Built with a ranking window whose limit Spark applies before the shuffle
    (``WindowGroupLimit``), so a value shared by many products sends at most
    k rows per map task.
    """
    base = products_wf.select("product_id", *[F.col(a).cast("string").alias(a) for a in ATTRIBUTES],
                              scorer.product_term(F.col("popularity")).alias("g"))
    keyed = base.select(
        "*", F.explode(F.array(
            F.struct(F.lit(GLOBAL).alias("attribute"), F.lit(GLOBAL).alias("value")),
            *[F.struct(F.lit(a).alias("attribute"), F.col(a).alias("value")) for a in ATTRIBUTES],
        )).alias("key")).select("key.attribute", "key.value", *base.columns).where(F.col("value").isNotNull())
    w = Window.partitionBy("attribute", "value").orderBy(F.col("g").desc(), F.col("product_id").asc())
    best = keyed.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    return best.groupBy("attribute", "value").agg(F.collect_list(F.struct(*base.columns)).alias("items"))


def _global_items(cands: DataFrame) -> Column:
    """The global list as a literal: k rows at most."""
    kind = cands.schema["items"].dataType
    row = cands.where(F.col("attribute") == GLOBAL).select("items").first()
    structs = [F.struct(*[F.lit(item[f.name]).cast(f.dataType).alias(f.name) for f in kind.elementType])
               for item in (row["items"] if row else [])]
    return F.array(*structs).cast(kind)


def requested_customers(requests: DataFrame, customers_wf: DataFrame, scorer: AffinityScorer) -> DataFrame:
    """Distinct requested customers with their term c and favourites.

    Each request turns into up to 12 x k candidate rows downstream, so the
    request rows are hash-partitioned by customer into the session's
    configured number of shuffle partitions. A size-based coalesce would see
    only the small request table and put the whole candidate fan-out in a few
    tasks. The customer columns are shuffled to the same partitioning (no side
    goes through the driver), and with broadcast candidate lists the candidate
    join, scoring and the per-customer ranking run on it without another
    exchange.
    """
    n = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    req = (requests.select("customer_id").where(F.col("customer_id").isNotNull())
           .repartition(n, "customer_id").dropDuplicates(["customer_id"]))
    side = customers_wf.select("customer_id", "total_purchases", *TOPS)
    return req.join(side.hint("merge"), "customer_id", "left").select(
        "customer_id", scorer.customer_term(F.col("total_purchases")).alias("c"),
        *[F.col(t).cast("string").alias(t) for t in TOPS])


def customer_keys(cust: DataFrame) -> DataFrame:
    """One row per favourite (attribute, value) of a requested customer, and one for the global list.

    The global row carries the customer's id as its value, so that it is no
    hot key where the lists are shuffled.
    """
    keys = F.array(F.struct(F.lit(GLOBAL).alias("attribute"), F.col("customer_id").cast("string").alias("value")),
                   *[F.struct(F.lit(f.attribute).alias("attribute"), F.col(f.top).alias("value")) for f in FAVOURITES])
    return (cust.select("*", F.explode(keys).alias("key"))
            .select("*", "key.attribute", "key.value").drop("key").where(F.col("value").isNotNull()))


def candidate_rows(requests: DataFrame, customers_wf: DataFrame, products_wf: DataFrame,
                   scorer: AffinityScorer = AffinityScorer(), k: int = TOP_K) -> DataFrame:
    """Every candidate of every requested customer: customer_id, product_id, g, logit."""
    joined = _matched_candidates(requests, customers_wf, products_wf, scorer, k)
    return joined.select("customer_id", "product_id", "g", scorer.logit(F.col("c"), F.col("g"), _bonus(scorer)).alias("logit"))


def _bonus(scorer: AffinityScorer) -> Column:
    return scorer.match_bonus({f.attribute: match_flag(F.col(f.top), F.col(f.attribute)) for f in FAVOURITES})


def _matched_candidates(requests: DataFrame, customers_wf: DataFrame, products_wf: DataFrame, scorer: AffinityScorer, k: int) -> DataFrame:
    """Candidates with the customer's c and favourites and the product's g and attributes."""
    # The lists are written once, so their bytes are known when the join is planned: within Spark's
    # broadcast threshold they are broadcast, beyond it the join shuffles and AQE splits its hot keys
    # (values of low-cardinality attributes) on the customer side.
    cands = stored(product_candidates(products_wf, scorer, k), "candidates")
    keys = customer_keys(requested_customers(requests, customers_wf, scorer))
    found = keys.join(cands.where(F.col("attribute") != GLOBAL), ["attribute", "value"], "left")
    items = F.when(F.col("attribute") == GLOBAL, _global_items(cands)).otherwise(F.col("items"))
    return found.select("customer_id", "c", *TOPS, F.inline(items))


def ranked_candidates(requests: DataFrame, customers_wf: DataFrame, products_wf: DataFrame,
                      scorer: AffinityScorer = AffinityScorer(), k: int = TOP_K) -> DataFrame:
    """The top-k (logit >= 0) per requested customer, long form.

    Columns: customer_id, rank (1..k), product_id, logit, probability.
    """
    joined = _matched_candidates(requests, customers_wf, products_wf, scorer, k)
    # rounding goes by way of decimal text: only sums that may round to 0 or more are rounded
    hopeful = joined.where(F.col("c") + F.col("g") + _bonus(scorer) > F.lit(-(10.0 ** -DECIMALS)))
    scored = hopeful.select("customer_id", "product_id", "g", scorer.logit(F.col("c"), F.col("g"), _bonus(scorer)).alias("logit"))
    # one product can arrive through several keys with identical rows: dense_rank gives them one rank
    w = Window.partitionBy("customer_id").orderBy(F.col("logit").desc(), F.col("g").desc(), F.col("product_id").asc())
    top = (scored.where(F.col("logit") >= 0)
           .withColumn("rank", F.dense_rank().over(w)).where(F.col("rank") <= k)
           .dropDuplicates(["customer_id", "product_id"]))
    return top.select("customer_id", F.col("rank").cast("int").alias("rank"), "product_id", "logit",
                      probability(F.col("logit")).alias("probability"))


def recommendations(requests: DataFrame, ranked: DataFrame) -> DataFrame:
    """One row per request row with its ordered id list; no eligible product -> empty list."""
    lists = ranked.groupBy("customer_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "product_id"))).alias("items"))
    lists = lists.select("customer_id", F.col("items.product_id").alias("list_product_id"))
    return (requests.select("customer_id").join(lists, "customer_id", "left")
            .select("customer_id", F.coalesce(F.col("list_product_id"), F.array().cast("array<bigint>"))
                    .alias("list_product_id")))


def prediction_lines(recs: DataFrame) -> DataFrame:
    """The predictions text line of each customer: ``id,[a, b]`` (S5 text form)."""
    return recs.select(F.concat(F.col("customer_id").cast("string"), F.lit(","),
                                format_id_list(F.col("list_product_id"), ", ")).alias("line"))


def submission(recs: DataFrame) -> DataFrame:
    """Recommendations -> submission rows ``(customer_id, '[a b]')`` (P5, Q7)."""
    return recs.select("customer_id", format_id_list(F.col("list_product_id"), " ").alias("list_product_id"))


#: fixed value: the first line of a predictions file
PREDICTIONS_HEADER = "customer_id, list_product_id"


def parse_prediction_lines(lines: DataFrame) -> DataFrame:
    """Predictions text -> submission rows, for predictions that exist as text only.

    Header lines are skipped (a folder has one per file). A line whose id is no
    number gives a row with a null id; ``unparsed_prediction_lines`` has those.
    """
    parts = F.split(F.col("line"), ",", 2)
    return _without_header(lines).select(parts[0].try_cast("bigint").alias("customer_id"),
                                         format_id_list(parse_id_list(parts[1]), " ").alias("list_product_id"))


def unparsed_prediction_lines(lines: DataFrame) -> DataFrame:
    """The lines that are neither a header nor begin with an id and a list."""
    fits = F.coalesce(F.col("line").rlike(r"^\s*\d+\s*,\s*\[[\d,\s]*\]\s*$"), F.lit(False))
    return _without_header(lines).where(~fits)


def _without_header(lines: DataFrame) -> DataFrame:
    return lines.where(~F.trim("line").eqNullSafe(F.lit(PREDICTIONS_HEADER)))
