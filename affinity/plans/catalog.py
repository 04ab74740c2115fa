"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the whole source tables of ``sf_dir``. Double outputs are
rounded to 6 decimals only here, at the very end, so that engines summing in
different orders compare equal; the library functions keep full precision.
Lists are emitted as ``[a b]`` text.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.functions.encode import encode_customers
from affinity.functions.lists import format_id_list
from affinity.operators import features as feat
from affinity.operators import boosting, labels, metrics, pairs, recommend
from affinity.operators.model import (AffinityScorer, TreeParams, fit_match_weights, fit_trees, fitted_scorer,
                                      model_frame_indexed, halving_search, random_search, search_report, tree_scores)
from affinity.operators.tree_topk import tree_top_k
from affinity.session import checkpoint_dir, stored
from affinity.sources import files, sinks, tables
from affinity.sources.schemas import CUSTOMERS, LABEL_COL, PRODUCTS
from affinity.sources.type_map import asserted, merged, read_type_map

DECIMALS = 6


def rounded(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    # rounded twice: the first snaps what summing in another order changes, so that exact halves go one way
    return df.select(*[F.round(F.round(F.col(f.name), decimals + 3), decimals).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def dates_as_text(df: DataFrame) -> DataFrame:
    """Purchase dates as ISO text where they may be missing (engines render a missing date differently)."""
    return df.withColumns({c: F.col(c).cast("string") for c in ("last_purchase_date", "first_purchase_date")})


class Inputs:
    """Source tables of one scale directory and the tables derived from them.

    With ``as_of``, features are computed from transactions before that day
    only; the default follows the reference, which sets no bound.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, scorer: AffinityScorer | None = None,
                 as_of: datetime.date | None = None):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self.scorer = scorer or AffinityScorer()

    #: the day that requests are scored for: here the first of the validation labels
    scoring_date = tables.SPLIT_DATE
    # one DataFrame per table: the scans are planned once
    customers = cached_property(lambda self: tables.customers(self.spark, self.sf_dir))
    products = cached_property(lambda self: tables.products(self.spark, self.sf_dir))
    all_tx = cached_property(lambda self: tables.transactions(self.spark, self.sf_dir))
    requests = cached_property(lambda self: tables.requests(self.spark, self.sf_dir))
    positives = cached_property(lambda self: tables.label_items(self.spark, self.sf_dir))

    @property
    def tx(self):
        """Transactions that features may see: all, or those before ``as_of``."""
        return self.all_tx if self.as_of is None else self.all_tx.where(F.col("time_date") < F.lit(self.as_of))

    def customer_features(self):
        return feat.customer_features(self.tx, self.products)

    def product_features(self):
        return feat.product_features(self.tx, self.customers)

    def customers_wf(self):
        return feat.customers_with_features(self.customers, self.customer_features())

    def products_wf(self):
        return feat.products_with_features(self.products, self.product_features())

    def labelled(self):
        return labels.labelled_pairs(self.positives, self.products)

    def share_sales(self):
        """Transactions and labels from one join of line items and orders, written once."""
        sold = stored(tables.sales(self.spark, self.sf_dir), "sales")
        self.all_tx = tables.transactions(self.spark, self.sf_dir, sold)
        self.positives = tables.label_items(self.spark, self.sf_dir, sold)

    def entities(self, customer_columns=None, product_columns=None):
        """Both entity tables, written: the shuffle files that make them are gone when pairs are joined to them."""
        customers, products = self.customers_wf(), self.products_wf()
        return (stored(customers.select(customer_columns or customers.columns), "customers-wf"),
                stored(products.select(product_columns or products.columns), "products-wf"))

    def training_set(self):
        self.share_sales()
        return pairs.labelled_training_set(self.positives, self.products, *self.entities())

    def ranking_inputs(self):
        return self.requests, self.customers_wf(), self.products_wf(), self.scorer

    def ranked(self):
        return recommend.ranked_candidates(*self.ranking_inputs())

    def recommendations(self):
        return recommend.recommendations(self.requests, self.ranked())

    def scored_pairs(self):
        return self.scorer.score_pairs(self.training_set())

    def match_weights(self):
        return fit_match_weights(self.training_set().where(F.col("split") == "train"))


class FileInputs(Inputs):
    """The same tables from CSV files; ``paths`` names customers, products, transactions, train_labels, val_labels, requests.

    ``paths`` may name a type map as ``types``: then the entity tables have its columns and types.
    """

    #: fixed value: the reference's scoring day
    scoring_date = datetime.date(2020, 9, 14)

    def __init__(self, spark: SparkSession, paths: dict[str, str], scorer: AffinityScorer | None = None,
                 as_of: datetime.date | None = None):
        super().__init__(spark, "", scorer, as_of)
        self.paths = paths

    @cached_property
    def types(self):
        return read_type_map(self.spark, self.paths["types"]) if "types" in self.paths else (CUSTOMERS, PRODUCTS)

    customers = cached_property(lambda self: files.read_customers(self.spark, self.paths["customers"], self.types[0]))
    products = cached_property(lambda self: files.read_products(self.spark, self.paths["products"], self.types[1]))

    def customers_wf(self):
        found = super().customers_wf()
        derived = T.StructType([f for f in found.schema if f.name not in self.types[0].names])
        # the two status columns are text in the files and numbers once encoded
        coded = T.StructType([T.StructField(f.name, T.DoubleType()) if f.name in ("member_status", "news_frequency") else f
                              for f in self.types[0]])
        return asserted(found, merged(coded, derived), "customers with features")

    def products_wf(self):
        found = super().products_wf()
        derived = T.StructType([f for f in found.schema if f.name not in self.types[1].names])
        return asserted(found, merged(self.types[1], derived), "products with features")

    all_tx = cached_property(lambda self: files.read_transactions(self.spark, self.paths["transactions"]))
    requests = cached_property(lambda self: files.read_requests(self.spark, self.paths["requests"]))

    def share_sales(self):
        pass  # the files have transactions and labels apart

    @cached_property
    def positives(self):
        lists = files.read_label_lists(self.spark, self.paths["train_labels"], "train").unionByName(
            files.read_label_lists(self.spark, self.paths["val_labels"], "val"))
        return labels.explode_labels(lists).select("split", "time_date", "customer_id", "product_id", "item_key")


def _q(fn):
    def run(spark, sf_dir):
        return fn(Inputs(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


@_q
def typed_customers(i):
    return i.customers


@_q
def typed_products(i):
    return i.products


@_q
def encoded_customers(i):
    return encode_customers(i.customers)


@_q
def transactions(i):
    return i.tx


@_q
def expanded_transactions(i):
    return feat.expand_transactions(i.tx, i.customers, i.products)


@_q
def attribute_counts(i):
    return feat.attribute_counts(i.tx, i.products)


@_q
def favourites(i):
    return feat.favourites(i.tx, i.products)


@_q
def favourites_observed(i):
    return feat.favourites(i.tx, i.products, closed_domain=False)


@_q
def favourites_rownumber(i):
    return feat.favourites_rownumber(feat.attribute_counts(i.tx, i.products), i.products)


@_q
def customer_rfm(i):
    return rounded(feat.customer_rfm(i.tx))


@_q
def product_price_stats(i):
    return rounded(feat.product_price_stats(i.tx))


@_q
def product_buyer_stats(i):
    return rounded(feat.product_buyer_stats(i.tx, i.customers))


@_q
def customer_features(i):
    return rounded(i.customer_features())


@_q
def product_features(i):
    return rounded(i.product_features())


@_q
def customers_with_features(i):
    return dates_as_text(rounded(i.customers_wf()))


@_q
def products_with_features(i):
    return rounded(i.products_wf())


@_q
def product_numbering(i):
    return labels.number_products(i.products)


@_q
def label_positives(i):
    return i.positives.withColumn(LABEL_COL, F.lit(1))


@_q
def label_negatives(i):
    return labels.sample_negatives(i.positives, i.products)


@_q
def label_negatives_strict(i):
    return labels.sample_negatives_strict(i.positives, i.products)


@_q
def labelled_pairs(i):
    return i.labelled()


@_q
def pair_features(i):
    wide = pairs.with_pair_features(pairs.labelled_with_entities(
        i.positives, i.products, *i.entities(pairs.PAIR_CUSTOMER, pairs.PAIR_PRODUCT)))
    return rounded(wide.select("split", "time_date", "customer_id", "product_id", "item_key", LABEL_COL,
                               *pairs.PAIR_FEATURES))


@_q
def training_set(i):
    return dates_as_text(rounded(i.training_set()))


@_q
def topk(i):
    return rounded(i.ranked())


@_q
def recommendations(i):
    recs = i.recommendations()
    return recs.select("customer_id", format_id_list(F.col("list_product_id")).alias("list_product_id"))


@_q
def submission(i):
    return recommend.submission(i.recommendations())


@_q
def parsed_predictions(i):
    return recommend.parse_prediction_lines(recommend.prediction_lines(i.recommendations()))


def customer_features_as_of(spark, sf_dir):
    return rounded(Inputs(spark, sf_dir, as_of=tables.SPLIT_DATE).customer_features())


@_q
def fitted_weights(i):
    return i.match_weights()


@_q
def recommendations_fitted(i):
    i.scorer = fitted_scorer(i.match_weights())
    recs = i.recommendations()
    return recs.select("customer_id", format_id_list(F.col("list_product_id")).alias("list_product_id"))


def parsed_text(spark, sf_dir):
    """The missing-value and cast rules of the CSV route over text made from every customer row."""
    key = F.col("c_custkey")
    token = F.element_at(F.array(*map(F.lit, ("NA", "None", "nan", "", "NONE", "n/a", "12x"))), (key % 7 + 1).cast("int"))
    text = tables._read(spark, sf_dir, "customer").select(
        key.alias("customer_id"), F.when(key % 3 == 0, token).otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string")).alias("n"),
        F.when(key % 5 == 0, token).otherwise(F.col("c_mktsegment")).alias("s"),
        F.when(key % 4 == 0, token).otherwise(F.concat(F.lit("2020-0"), (1 + key % 9).cast("string"), F.lit("-15"))).alias("d"))
    kinds = {"n": T.DoubleType(), "s": T.StringType(), "d": T.DateType()}
    out = text.select("customer_id", *[files.normalise_missing(F.col(c), k).alias(c) for c, k in kinds.items()])
    return out.withColumn("d", F.col("d").cast("string"))


def exploded_lists(spark, sf_dir):
    """Label-list text made from every product row, parsed and exploded; some lists are empty."""
    key = F.col("p_partkey")
    text = F.when(key % 10 == 0, "[]").otherwise(F.concat(
        F.lit("["), F.concat_ws(" ", key.cast("string"), F.col("p_size").cast("string"), key.cast("string")), F.lit("]")))
    lists = tables._read(spark, sf_dir, "part").select(key.alias("customer_id"), text.alias("list_product_id"))
    return labels.explode_labels(lists)


def _as_csv(df: DataFrame) -> str:
    """Path of the table written as CSV files in the shared folder."""
    path = f"{checkpoint_dir(df.sparkSession)}/csv-{uuid.uuid4().hex}"
    sinks.write_csv(df, path)
    return path


@_q
def csv_customers(i):
    """Every customer, written as CSV and read by the typed scan."""
    return files.read_customers(i.spark, _as_csv(i.customers))


@_q
def csv_products(i):
    return files.read_products(i.spark, _as_csv(i.products))


@_q
def csv_transactions(i):
    """Every transaction by way of CSV files."""
    return files.read_transactions(i.spark, _as_csv(i.all_tx))


@_q
def csv_requests(i):
    """Every request by way of CSV files, null ids too (S3)."""
    return files.read_requests(i.spark, _as_csv(i.requests))


def csv_label_lists(spark, sf_dir):
    """A dated label list made from every product row, by way of CSV files, exploded."""
    key = F.col("p_partkey")
    lists = tables._read(spark, sf_dir, "part").select(
        F.when(key % 11 != 0, F.date_add(F.lit(datetime.date(2020, 1, 1)), F.col("p_size").cast("int"))).alias("time_date"), key.alias("customer_id"),
        F.when(key % 10 == 0, "[]").otherwise(F.concat(F.lit("["), F.concat_ws(" ", key.cast("string"), F.col("p_size").cast("string")), F.lit("]"))).alias("list_product_id"))
    found = labels.explode_labels(files.read_label_lists(spark, _as_csv(lists), "val"))
    return found.withColumn("time_date", F.col("time_date").cast("string"))


@_q
def random_search_report(i):
    train = i.training_set().where(F.col("split") == "train")
    return search_report(i.spark, random_search(train))


@_q
def halving_search_report(i):
    train = i.training_set().where(F.col("split") == "train")
    return halving_search(train, refit=False)[1]


@_q
def model_inputs(i):
    return rounded(model_frame_indexed(i.training_set()))


@_q
def scored_pairs(i):
    s = i.scored_pairs()
    return rounded(s.select("split", "time_date", "customer_id", "product_id", LABEL_COL, "logit", "probability"))


@_q
def confusion_metrics(i):
    return rounded(metrics.confusion_metrics(i.scored_pairs(), by=["split"]))


@_q
def ranking_metrics(i):
    return rounded(metrics.ranking_metrics(i.scored_pairs(), by=["split"]))


@_q
def evaluation_report(i):
    return rounded(metrics.evaluation_report(i.scored_pairs(), by=["split"]))


def _checkpointed_training_set(i):
    # read twice (fit, then scoring): written once to the shared checkpoint folder, as compressed columns
    return stored(i.training_set(), "training-set")


@_q
def gbt_scores(i):
    ts = _checkpointed_training_set(i)
    model = fit_trees(ts.where(F.col("split") == "train"), TreeParams())
    return tree_scores(model, ts)


@_q
def gbt_evaluation_report(i):
    ts = _checkpointed_training_set(i)
    model = fit_trees(ts.where(F.col("split") == "train"), TreeParams())
    return metrics.evaluation_report(tree_scores(model, ts), prob="probability", score="probability", by=["split"])


@_q
def boost_inputs(i):
    return rounded(boosting.boost_frame(_checkpointed_training_set(i)))


@_q
def boosted_report(i):
    frame = stored(boosting.boost_frame(_checkpointed_training_set(i)), "boost-frame")
    model = boosting.fit_boosting(frame.where(F.col("split") == "train"))
    return metrics.evaluation_report(boosting.boosted_probability(model, frame), prob="probability", score="probability", by=["split"])


@_q
def recommendations_trees(i):
    """The reference's own job: the 12 best products of every requested customer by the fitted trees."""
    cwf, pwf = stored(i.customers_wf(), "customers-wf"), stored(i.products_wf(), "products-wf")
    train = i.positives.where(F.col("split") == "train")
    model = fit_trees(pairs.labelled_training_set(train, i.products, cwf, pwf), TreeParams())
    recs = recommend.recommendations(i.requests, tree_top_k(model, i.requests, cwf, pwf, i.scoring_date))
    return recs.select("customer_id", format_id_list(F.col("list_product_id")).alias("list_product_id"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    qs = [typed_customers, typed_products, encoded_customers, transactions, expanded_transactions,
          attribute_counts, favourites, favourites_observed, favourites_rownumber, customer_rfm, product_price_stats,
          product_buyer_stats, customer_features, product_features, customers_with_features,
          products_with_features, product_numbering, label_positives, label_negatives, label_negatives_strict, labelled_pairs,
          pair_features, training_set, topk, recommendations, submission, parsed_predictions,
          customer_features_as_of, model_inputs, fitted_weights, recommendations_fitted, parsed_text, exploded_lists,
          random_search_report, halving_search_report, scored_pairs,
          confusion_metrics, ranking_metrics, evaluation_report, gbt_scores, gbt_evaluation_report, recommendations_trees,
          boost_inputs, boosted_report, csv_customers, csv_products, csv_transactions, csv_requests, csv_label_lists]
    return {q.__name__: q for q in qs}
