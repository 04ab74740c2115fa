"""Pair features (Q3) and the labelled training / validation set (Q4).

Positives with their draw are joined to the customer side, become two rows and
meet the product side once: positives by product id, negatives by the drawn number,
so that no join of its own turns numbers into ids. The customer's favourites
and demographics, which every pair carries to its product, travel packed. Both joins are on a unique entity key with the columns the pairs need;
Spark picks broadcast or shuffle from measured bytes, and AQE splits a hot
customer or product of a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.packing import folded, packed_text, unfolded, unpacked_text
from affinity.functions.pairs import DEMOGRAPHICS, FAVOURITES, match_flag, standardised_difference
from affinity.operators import labels
from affinity.sources.schemas import LABEL_COL

#: columns of a customer that every pair carries to its product
CARRIED = [f.top for f in FAVOURITES] + ["total_purchases", "last_purchase_date", "first_purchase_date"] + [d.customer_col for d in DEMOGRAPHICS]
MATCHES = [f.match for f in FAVOURITES]
DIFFERENCES = [d.difference for d in DEMOGRAPHICS]
PAIR_FEATURES = MATCHES + DIFFERENCES
#: the entity columns that pair features come from
PAIR_CUSTOMER = ["customer_id", *[f.top for f in FAVOURITES], *[d.customer_col for d in DEMOGRAPHICS]]
PAIR_PRODUCT = ["product_id", *[f.attribute for f in FAVOURITES], *[c for d in DEMOGRAPHICS for c in (d.mean, d.std)]]

# Column order of the reference's model frame (keys and label included).
TRAINING_COLUMNS = [
    "time_date", "customer_id", "product_id", "last_purchase_date", "first_purchase_date",
    "total_purchases", "total_spent", LABEL_COL, "prod_group_name", "average_price",
    "price_std", "popularity",
] + PAIR_FEATURES

MODEL_FEATURES = [c for c in TRAINING_COLUMNS if c not in ("customer_id", "product_id", LABEL_COL)]


def match_columns():
    return [match_flag(F.col(f.top), F.col(f.attribute)).alias(f.match) for f in FAVOURITES]


def difference_columns():
    return [standardised_difference(F.col(d.customer_col), F.col(d.mean), F.col(d.std)).alias(d.difference)
            for d in DEMOGRAPHICS]


def with_pair_features(df: DataFrame) -> DataFrame:
    """Adds the 11 match flags and 5 standardised differences."""
    return df.select("*", *match_columns(), *difference_columns())


def _carried(customers_wf: DataFrame) -> list[str]:
    return [c for c in CARRIED if c in customers_wf.columns]


def attach_entities(pairs: DataFrame, customers_wf: DataFrame, products_wf: DataFrame) -> DataFrame:
    """Pairs left-joined to customer (J6) and product (J7) columns."""
    wide = pairs.join(folded(customers_wf, _carried(customers_wf)), "customer_id", "left").join(products_wf, "product_id", "left")
    return unfolded(wide, _carried(customers_wf))


def labelled_with_entities(positives: DataFrame, products: DataFrame, customers_wf: DataFrame, products_wf: DataFrame,
                           seed: int = labels.SEED, buckets: int = labels.NUMBERING_BUCKETS) -> DataFrame:
    """The rows of ``attach_entities`` over ``labelled_pairs``: draw (N1), customers (J6), union (U1), products."""
    key = packed_text(F.col("item_key"))
    drawn = labels.with_draws(positives, products, seed).withColumns({"packed_key": key, "item_key": F.when(key.isNull(), F.col("item_key"))})
    drawn = drawn.join(folded(customers_wf, _carried(customers_wf)), "customer_id", "left")
    found = labels.by_product_key(products_wf, products, buckets)
    wide = labels.labelled_keys(drawn).join(found, ["product_key", LABEL_COL], "left")
    # a positive of an unknown product keeps its id
    own = F.when(F.col(LABEL_COL) == 1, F.col("product_key")).otherwise(F.col("product_id")).alias("product_id")
    item = F.when(F.col("packed_key").isNotNull(), unpacked_text(F.col("packed_key"))).otherwise(F.col("item_key")).alias("item_key")
    given = {"product_id": own, "item_key": item}
    return unfolded(wide.select(*[given.get(c, F.col(c)) for c in wide.columns if c not in ("product_key", "packed_key")]), _carried(customers_wf))


def training_set(pairs: DataFrame, customers_wf: DataFrame, products_wf: DataFrame) -> DataFrame:
    """The model frame: keys, label, 9 entity features and 16 pair features.

    ``split`` is carried along when present, so both splits are one DataFrame.
    """
    return _frame(attach_entities(pairs, customers_wf, products_wf))


def labelled_training_set(positives: DataFrame, products: DataFrame, customers_wf: DataFrame, products_wf: DataFrame) -> DataFrame:
    """``training_set`` over the labelled pairs of ``positives``."""
    return _frame(labelled_with_entities(positives, products, customers_wf, products_wf))


def _frame(attached: DataFrame) -> DataFrame:
    lead = ["split"] if "split" in attached.columns else []
    return with_pair_features(attached).select(*lead, *TRAINING_COLUMNS)
