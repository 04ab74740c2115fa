"""Customer-product pair expressions (P7, P8, P9) and the attribute tables
that drive them.

The tables are the single description of which customer favourite is
compared with which product attribute; features, pair features and the
candidate generator are all generated from them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Favourite(NamedTuple):
    top: str          # customer feature: the favourite value
    attribute: str    # product attribute it is compared with
    match: str        # name of the pair match flag
    closed_domain: bool  # category attribute: an all-missing customer falls back to the domain minimum


# Feature names and the attribute pairing of the reference model.
FAVOURITES = [
    Favourite("top_perceived_color", "perceived_colour_value_id", "perceived_color_match", False),
    Favourite("top_prod_group", "prod_group_name", "prod_group_match", True),
    Favourite("top_idx_group_no", "idx_group_no", "idx_group_match", True),
    Favourite("top_sec_no", "sec_no", "sec_no_match", False),
    Favourite("top_garment_group_no", "garment_group_no", "garment_group_no_match", True),
    Favourite("top_idx_code", "idx_code", "idx_code_match", True),
    Favourite("top_department_no", "department_no", "department_no_match", False),
    Favourite("top_prod_type_no", "prod_type_no", "prod_type_no_match", False),
    Favourite("top_graph_appearance_no", "graph_appearance_no", "graph_appearance_no_match", False),
    Favourite("top_colour_group_code", "colour_group_code", "colour_group_code_match", False),
    Favourite("top_perceived_colour_master_id", "perceived_colour_master_id", "perceived_colour_master_id_match", False),
]


class Demographic(NamedTuple):
    customer_col: str  # encoded customer attribute
    mean: str          # per-product mean over its buyers
    std: str           # per-product sample std over its buyers
    difference: str    # name of the standardised difference


# Buyer demographics summarised per product, and their pair differences.
DEMOGRAPHICS = [
    Demographic("age", "average_age", "std_age", "age_similarity"),
    Demographic("FN", "average_FN", "std_FN", "FN_similarity"),
    Demographic("active_status", "average_active", "std_active", "active_similarity"),
    Demographic("member_status", "average_member", "std_member", "member_similarity"),
    Demographic("news_frequency", "average_news", "std_news", "news_similarity"),
]

MATCH_COLUMNS = [f.match for f in FAVOURITES]
DIFFERENCE_COLUMNS = [d.difference for d in DEMOGRAPHICS]


def match_flag(a: Column, b: Column) -> Column:
    """True only when both sides are present and equal (null = null is false)."""
    return F.coalesce(a == b, F.lit(False))


def standardised_difference(x: Column, mean: Column, std: Column) -> Column:
    """(x - mean) / std, null when any input is null (P8). ``std`` is never 0 (see P9)."""
    return (x - mean) / std


def unit_if_zero(std: Column) -> Column:
    """A zero std becomes 1; a null std (single buyer) stays null."""
    return F.when(std == 0, F.lit(1.0)).otherwise(std)
