"""Logical schemas of the input tables, as explicit Spark types.

Every table is read with a declared schema (no inference). Key columns are
``bigint``; the reference's ``category`` columns over text are strings and
over numbers stay numeric, so that ordering (and therefore tie-breaking in
favourite values) is numeric.
"""

from pyspark.sql import types as T

CUSTOMER_KEY = "customer_id"
PRODUCT_KEY = "product_id"
# Fixed value: the name of the label column.
LABEL_COL = "link_pred_baseline_target"

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("FN", T.DoubleType()),
    T.StructField("active_status", T.DoubleType()),
    T.StructField("member_status", T.StringType()),
    T.StructField("news_frequency", T.StringType()),
    T.StructField("age", T.DoubleType()),
    T.StructField("postal_code", T.StringType()),
])

_L, _S = T.LongType(), T.StringType()

PRODUCTS = T.StructType([T.StructField("product_id", T.LongType(), False)] + [
    T.StructField(name, typ) for name, typ in [
        ("product_code", _L), ("prod_name", _S), ("prod_type_no", _L), ("prod_type_name", _S),
        ("prod_group_name", _S), ("graph_appearance_no", _L), ("graph_appearance_name", _S),
        ("colour_group_code", _L), ("colour_group_name", _S), ("perceived_colour_value_id", _L),
        ("perceived_colour_value_name", _S), ("perceived_colour_master_id", _L),
        ("perceived_colour_master_name", _S), ("department_no", _L), ("department_name", _S),
        ("idx_code", _S), ("idx_name", _S), ("idx_group_no", _L), ("idx_group_name", _S),
        ("sec_no", _L), ("sec_name", _S), ("garment_group_no", _L), ("garment_group_name", _S),
        ("detail_desc", _S),
    ]
])

TRANSACTIONS = T.StructType([
    T.StructField("time_date", T.DateType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("sales_channel_id", T.IntegerType()),
])

LABEL_LISTS = T.StructType([
    T.StructField("time_date", T.DateType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("list_product_id", T.StringType()),
])

REQUESTS = T.StructType([T.StructField("customer_id", T.LongType())])

# The text tokens that the reference's CSV reader (pandas
# defaults) turns into missing values. Upper-case "NONE" is not among them.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
