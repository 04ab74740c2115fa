"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written in a different form from the Spark code on purpose:
favourites use ``row_number`` instead of ``mode``, recommendations are a
brute-force ranking over every (request, product) pair instead of the
candidate generator, and metrics use plain window sums. The driver runs it
on views named after the parquet tables.
"""

from __future__ import annotations

from types import SimpleNamespace

SPLIT_DATE = "2001-01-01"
SEED = 73
R = 6  # decimals of double outputs, as in the Spark query wrappers

# Fixed values, written out here and not imported, so that a wrong code, pairing or weight in the library shows.
MEMBER_STATUS_CODES = {"ACTIVE": 1.0, "PRE-CREATE": 1.0, "LEFT CLUB": -1.0}
NEWS_FREQUENCY_CODES = {"NONE": -1.0, "Regularly": 1.0, "Monthly": 0.5}
FAVOURITES = [SimpleNamespace(top=t, attribute=a, match=m, closed_domain=a in (
    "prod_group_name", "idx_group_no", "garment_group_no", "idx_code")) for t, a, m in [
        ("top_perceived_color", "perceived_colour_value_id", "perceived_color_match"),
        ("top_prod_group", "prod_group_name", "prod_group_match"),
        ("top_idx_group_no", "idx_group_no", "idx_group_match"),
        ("top_sec_no", "sec_no", "sec_no_match"),
        ("top_garment_group_no", "garment_group_no", "garment_group_no_match"),
        ("top_idx_code", "idx_code", "idx_code_match"),
        ("top_department_no", "department_no", "department_no_match"),
        ("top_prod_type_no", "prod_type_no", "prod_type_no_match"),
        ("top_graph_appearance_no", "graph_appearance_no", "graph_appearance_no_match"),
        ("top_colour_group_code", "colour_group_code", "colour_group_code_match"),
        ("top_perceived_colour_master_id", "perceived_colour_master_id", "perceived_colour_master_id_match")]]
DEMOGRAPHICS = [SimpleNamespace(customer_col=c, mean=f"average_{n}", std=f"std_{n}", difference=f"{n}_similarity")
                for c, n in [("age", "age"), ("FN", "FN"), ("active_status", "active"), ("member_status", "member"),
                             ("news_frequency", "news")]]
SCORER = SimpleNamespace(intercept=-3.5, frequency_weight=0.3, popularity_weight=0.4, match_weights={
    "department_no": 1.2, "sec_no": 1.1, "prod_type_no": 0.9, "garment_group_no": 0.9, "colour_group_code": 0.8,
    "perceived_colour_value_id": 0.7, "graph_appearance_no": 0.6, "prod_group_name": 0.6, "idx_code": 0.5,
    "perceived_colour_master_id": 0.4, "idx_group_no": 0.3})


def rnd(expr: str, decimals: int = R) -> str:
    """Round like Spark's ``round`` on doubles: HALF_UP on the shortest decimal form."""
    value = f"cast(cast(cast({expr} as double) as varchar) as decimal(38, 12))"
    if decimals == R:
        value = f"round({value}, {R + 3})"
    return f"cast(round({value}, {decimals}) as double)"


def ref(col: str) -> str:
    """A key as transactions, labels and requests write it: multiples of 50 have no entity."""
    return f"(case when {col} % 50 = 0 then {col} + 1000000000 else {col} end)"


CUSTOMERS = """
select c_custkey as customer_id,
       case when c_custkey % 3 = 0 then null else cast(1 as double) end as FN,
       case when c_custkey % 4 = 1 then null else cast(1 as double) end as active_status,
       case c_mktsegment when 'AUTOMOBILE' then 'ACTIVE' when 'BUILDING' then 'PRE-CREATE'
            when 'FURNITURE' then 'LEFT CLUB' when 'HOUSEHOLD' then 'OTHER' end as member_status,
       case c_nationkey % 4 when 0 then 'NONE' when 1 then 'Regularly' when 2 then 'Monthly' end as news_frequency,
       case when c_custkey % 11 = 0 then null else cast(16 + c_custkey % 60 as double) end as age,
       concat('pc', cast(c_nationkey as varchar)) as postal_code
from customer"""

PRODUCTS = """
select p_partkey as product_id, p_partkey - p_partkey % 4 as product_code, p_name as prod_name,
       cast(p_size % 12 as bigint) as prod_type_no, concat('type ', cast(p_size % 12 as varchar)) as prod_type_name,
       case when p_partkey % 17 = 0 then null else p_type end as prod_group_name,
       p_partkey % 7 as graph_appearance_no, concat('look ', cast(p_partkey % 7 as varchar)) as graph_appearance_name,
       p_partkey % 11 as colour_group_code, concat('colour ', cast(p_partkey % 11 as varchar)) as colour_group_name,
       case when p_partkey % 13 = 0 then null else p_partkey % 8 end as perceived_colour_value_id,
       concat('value ', cast(p_partkey % 8 as varchar)) as perceived_colour_value_name,
       p_partkey % 5 as perceived_colour_master_id,
       concat('master ', cast(p_partkey % 5 as varchar)) as perceived_colour_master_name,
       cast(p_size as bigint) as department_no, concat('dept ', cast(p_size as varchar)) as department_name,
       case when p_partkey % 2 = 0 then null else substring(p_type, 1, 1) end as idx_code, p_type as idx_name,
       cast(p_size % 4 as bigint) as idx_group_no, concat('group ', cast(p_size % 4 as varchar)) as idx_group_name,
       cast(substring(p_brand, 7) as bigint) as sec_no, p_brand as sec_name,
       1 + cast(substring(p_brand, 7) as bigint) % 12 as garment_group_no,
       concat('garment ', substring(p_brand, 7)) as garment_group_name, p_name as detail_desc
from part"""

TRANSACTIONS = f"""
select cast(o_orderdate as date) as time_date, {ref('o_custkey')} as customer_id, {ref('l_partkey')} as product_id,
       l_extendedprice as price, cast(1 + l_linenumber % 2 as integer) as sales_channel_id
from lineitem join orders on l_orderkey = o_orderkey"""


def _case_map(col: str, codes: dict[str, float]) -> str:
    whens = " ".join(f"when '{k}' then {v!r}" for k, v in codes.items())
    return f"cast(case {col} {whens} else 0.0 end as double)"


ENCODED_CUSTOMERS = f"""
select customer_id, coalesce(FN, -1.0) as FN, coalesce(active_status, -1.0) as active_status,
       {_case_map('member_status', MEMBER_STATUS_CODES)} as member_status,
       {_case_map('news_frequency', NEWS_FREQUENCY_CODES)} as news_frequency,
       age, postal_code
from customers"""

BASE_CTES = f"""customers as ({CUSTOMERS}),
products as ({PRODUCTS}),
tx as ({TRANSACTIONS}),
enc as ({ENCODED_CUSTOMERS})"""

ATTRS = [f.attribute for f in FAVOURITES]
NUMERIC_ATTRS = [a for a in ATTRS if a not in ("prod_group_name", "idx_code")]


def _favourite_cte(f) -> str:
    a = f.attribute
    return f"""fav_{a} as (
  select customer_id, v as {f.top} from (
    select customer_id, {a} as v,
           row_number() over (partition by customer_id order by count(*) desc, {a} asc) as rn
    from txp where {a} is not null group by customer_id, {a}) where rn = 1)"""


def _favourites_ctes() -> str:
    parts = [f"txp as (select t.customer_id, t.product_id, p.* exclude (product_id) "
             f"from tx t left join products p on t.product_id = p.product_id where t.customer_id is not null)"]
    parts += [_favourite_cte(f) for f in FAVOURITES]
    return ",\n".join(parts)


def _favourite_select(closed_domain: bool = True) -> str:
    cols = []
    for f in FAVOURITES:
        if closed_domain and f.closed_domain:
            cols.append(f"coalesce(fav_{f.attribute}.{f.top}, (select min({f.attribute}) from products)) as {f.top}")
        else:
            cols.append(f"fav_{f.attribute}.{f.top}")
    joins = " ".join(f"left join fav_{f.attribute} using (customer_id)" for f in FAVOURITES)
    return ", ".join(cols), joins


def customer_rfm() -> str:
    return f"""with {BASE_CTES}
select customer_id, max(time_date) as last_purchase_date, min(time_date) as first_purchase_date,
       count(*) as total_purchases, {rnd('coalesce(sum(price), 0.0)')} as total_spent
from tx where customer_id is not null group by customer_id"""


def favourites(closed_domain: bool = True) -> str:
    cols, joins = _favourite_select(closed_domain)
    return f"""with {BASE_CTES}, {_favourites_ctes()},
cust as (select distinct customer_id from txp)
select customer_id, {cols} from cust {joins}"""


def customer_features() -> str:
    cols, joins = _favourite_select(True)
    return f"""with {BASE_CTES}, {_favourites_ctes()},
rfm as (select customer_id, max(time_date) as last_purchase_date, min(time_date) as first_purchase_date,
        count(*) as total_purchases, coalesce(sum(price), 0.0) as total_spent
        from tx where customer_id is not null group by customer_id)
select customer_id, last_purchase_date, first_purchase_date, total_purchases,
       {rnd('total_spent')} as total_spent, {cols}
from rfm {joins}"""



DEMO = DEMOGRAPHICS


def _stats_select() -> str:
    cols = []
    for d in DEMO:
        cols.append(f"avg({d.customer_col}) as {d.mean}")
        cols.append(f"case when stddev_samp({d.customer_col}) = 0 then 1.0 "
                    f"else stddev_samp({d.customer_col}) end as {d.std}")
    return ", ".join(cols)


PRODUCT_DOUBLES = ["average_price", "price_std"] + [c for d in DEMOGRAPHICS for c in (d.mean, d.std)]
CUSTOMER_DOUBLES = ["FN", "active_status", "member_status", "news_frequency", "age", "total_spent"]


DATES = ["last_purchase_date", "first_purchase_date"]


def rounded_star(doubles: list[str], dates: list[str] = ()) -> str:
    parts = [f"{rnd(c)} as {c}" for c in doubles] + [f"cast({c} as varchar) as {c}" for c in dates]
    return f"* replace ({', '.join(parts)})"


def _buyers_cte() -> str:
    return ("buyers as (select t.product_id, t.price, e.* exclude (customer_id) "
            "from tx t left join enc e on t.customer_id = e.customer_id where t.product_id is not null)")


def product_price_stats() -> str:
    return f"""with {BASE_CTES}
select product_id, {rnd('avg(price)')} as average_price, {rnd('stddev_samp(price)')} as price_std,
       count(*) as popularity
from tx where product_id is not null group by product_id"""


def product_buyer_stats() -> str:
    return f"""with {BASE_CTES}, {_buyers_cte()}
select {rounded_star(PRODUCT_DOUBLES[2:])} from (select product_id, {_stats_select()} from buyers group by product_id)"""


def _product_features_cte() -> str:
    return f"""{_buyers_cte()},
pf as (select product_id, avg(price) as average_price, stddev_samp(price) as price_std,
       count(*) as popularity, {_stats_select()} from buyers group by product_id)"""


def _customer_features_cte() -> str:
    cols, joins = _favourite_select(True)
    return f"""{_favourites_ctes()},
rfm as (select customer_id, max(time_date) as last_purchase_date, min(time_date) as first_purchase_date,
        count(*) as total_purchases, coalesce(sum(price), 0.0) as total_spent
        from tx where customer_id is not null group by customer_id),
cf as (select customer_id, last_purchase_date, first_purchase_date, total_purchases, total_spent, {cols}
       from rfm {joins})"""


FEATURE_CTES = f"""{BASE_CTES}, {_customer_features_cte()}, {_product_features_cte()},
cwf as (select * from enc left join cf using (customer_id)),
pwf as (select * from products left join pf using (product_id))"""


def product_features() -> str:
    return f"with {FEATURE_CTES}\nselect {rounded_star(PRODUCT_DOUBLES)} from pf"


def attribute_counts() -> str:
    parts = [f"select customer_id, '{a}' as attribute, cast({a} as varchar) as value, count(*) as cnt "
             f"from txp where {a} is not null group by customer_id, {a}" for a in ATTRS]
    return f"with {BASE_CTES}, {_favourites_ctes()}\n" + "\nunion all\n".join(parts)


def favourites_rownumber() -> str:
    parts = [f"select customer_id, '{f.attribute}' as attribute, cast({f.top} as varchar) as top_value "
             f"from fav_{f.attribute}" for f in FAVOURITES]
    return f"with {BASE_CTES}, {_favourites_ctes()}\n" + "\nunion all\n".join(parts)


def expanded_transactions() -> str:
    return f"""with {BASE_CTES}
select t.*, e.* exclude (customer_id), p.* exclude (product_id)
from tx t left join enc e on t.customer_id = e.customer_id left join products p on t.product_id = p.product_id"""


BUCKETS = 1024


def _h60(expr: str) -> str:
    return f"cast(('0x' || substr(md5({expr}), 1, 15)) as bigint)"


NUMBERING_CTE = f"""ids as (select product_id, {_h60('cast(product_id as varchar)')} % {BUCKETS} as bucket from products),
bcnt as (select bucket, count(*) as n from ids group by bucket),
boff as (select bucket, coalesce(sum(n) over (order by bucket rows between unbounded preceding and 1 preceding), 0) as off
         from bcnt),
numbered as (select product_id,
             cast(off + row_number() over (partition by bucket order by product_id) - 1 as bigint) as product_idx
             from ids join boff using (bucket))"""

POSITIVES_CTE = f"""od as (select o_orderkey, {ref('o_custkey')} as customer_id, cast(o_orderdate as date) as time_date from orders),
oj as (select * from od left join lineitem on l_orderkey = o_orderkey),
positives as (
  select case when time_date < date '{SPLIT_DATE}' then 'train' else 'val' end as split, time_date, customer_id,
         {ref('l_partkey')} as product_id,
         concat_ws(':', cast(o_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar),
                   cast(l_suppkey as varchar)) as item_key
  from oj where l_partkey is not null
  union all
  select case when time_date < date '{SPLIT_DATE}' then 'train' else 'val' end as split, time_date, customer_id,
         cast(null as bigint) as product_id, '' as item_key
  from oj group by time_date, customer_id having count(l_partkey) = 0)"""

NEGATIVES_CTE = f"""nprod as (select count(*) as n from products),
drawn as (select split, time_date, customer_id, item_key,
          {_h60("concat_ws('|', '" + str(SEED) + "', cast(time_date as varchar), coalesce(cast(customer_id as varchar), 'null'), coalesce(cast(product_id as varchar), 'null'), item_key)")} % (select n from nprod) as product_idx
          from positives),
negatives as (select split, time_date, customer_id, item_key, product_id from drawn join numbered using (product_idx)),
labelled as (select split, time_date, customer_id, product_id, item_key, 1 as link_pred_baseline_target from positives
             union all
             select split, time_date, customer_id, product_id, item_key, 0 from negatives)"""

LABEL_CTES = f"{NUMBERING_CTE},\n{POSITIVES_CTE},\n{NEGATIVES_CTE}"

# Strict negatives: the first of the row's keyed draws j = 0, 1, ... that is not a positive
# of the customer in the split. 256 draws are enumerated here; at these sizes a row needing
# more has probability below 1e-300.
STRICT_CTE = f"""known as (select distinct split, customer_id, product_id as neg from positives where product_id is not null),
sdraws as (select p.split, p.time_date, p.customer_id, p.item_key, t.j,
           {_h60("concat_ws('|', '" + str(SEED) + "', cast(p.time_date as varchar), coalesce(cast(p.customer_id as varchar), 'null'), coalesce(cast(p.product_id as varchar), 'null'), p.item_key, cast(t.j as varchar))")} % (select n from nprod) as product_idx
           from (select distinct * from positives) p, range(0, 256) t(j)),
scand as (select d.*, nb.product_id as neg from sdraws d join numbered nb using (product_idx)),
sok as (select * from scand c where not exists
        (select 1 from known k where k.split = c.split and k.customer_id = c.customer_id and k.neg = c.neg)),
strict1 as (select split, time_date, customer_id, item_key, arg_min(neg, j) as product_id
            from sok group by split, time_date, customer_id, item_key),
strict as (select p.split, p.time_date, p.customer_id, p.item_key, s.product_id
           from positives p join strict1 s using (split, time_date, customer_id, item_key))"""


def _pair_select() -> str:
    cols = [f"coalesce({f.top} = {f.attribute}, false) as {f.match}" for f in FAVOURITES]
    cols += [f"({d.customer_col} - {d.mean}) / {d.std} as {d.difference}" for d in DEMO]
    return ", ".join(cols)


PAIRS_CTE = f"""wide as (select l.*, c.* exclude (customer_id), p.* exclude (product_id)
         from labelled l left join cwf c on l.customer_id = c.customer_id
         left join pwf p on l.product_id = p.product_id),
pairs as (select *, {_pair_select()} from wide)"""

MATCHES = ", ".join(f.match for f in FAVOURITES)
DIFFS = ", ".join(d.difference for d in DEMO)
RDIFFS = ", ".join(f"{rnd(d.difference)} as {d.difference}" for d in DEMO)
TRAINING_DOUBLES = ["total_spent", "average_price", "price_std"] + [d.difference for d in DEMO]
TRAINING_SELECT = ("split, time_date, customer_id, product_id, last_purchase_date, first_purchase_date, "
                   "total_purchases, total_spent, link_pred_baseline_target, prod_group_name, average_price, "
                   f"price_std, popularity, {MATCHES}, {DIFFS}")


# day numbers, 0 / 1 flags, the sentinel for what is missing, and codes by falling frequency in the training split
_DAYS = ", ".join(f"coalesce(cast(date_diff('day', date '1970-01-01', {c}) as double), -1e9) as {c}"
                  for c in ("time_date", "last_purchase_date", "first_purchase_date"))
_NUMBERS = ", ".join([f"coalesce(cast({c} as double), -1e9) as {c}" for c in ("total_purchases", "popularity")]
                     + [f"coalesce({rnd(c)}, -1e9) as {c}" for c in ("total_spent", "average_price", "price_std")]
                     + [f"coalesce(cast({f.match} as double), -1e9) as {f.match}" for f in FAVOURITES]
                     + [f"coalesce({rnd(d.difference)}, -1e9) as {d.difference}" for d in DEMO])
MODEL_INPUTS = f""", codes as (select prod_group_name as g, row_number() over (order by count(*) desc, prod_group_name) - 1 as code
  from pairs where split = 'train' and prod_group_name is not null group by prod_group_name)
select split, customer_id, product_id, link_pred_baseline_target, {_DAYS}, {_NUMBERS},
  cast(coalesce(code, (select count(*) from codes)) as double) as prod_group_name_idx
from pairs left join codes on g = prod_group_name"""


# missing values stay missing; a training pair is coded from the pairs of the other four folds, any other from all
_KEY = ", ".join(f"coalesce(cast({c} as varchar), 'null')" for c in ("split", "time_date", "customer_id", "product_id", "link_pred_baseline_target"))
BOOST_INPUTS = f""", folded as (select *, case when split = 'train' then {_h60(f"concat_ws('|', '{SEED}', {_KEY})")} % 5 else -1 end as fold from pairs),
fc as (select prod_group_name as g, fold, count(*) as n, sum(link_pred_baseline_target) as y from folded where fold >= 0 group by all),
wc as (select g, sum(n) as n, sum(y) as y from fc group by g), oc as (select sum(y) / sum(n) as r from wc)
select split, customer_id, product_id, link_pred_baseline_target, {_DAYS.replace("coalesce(", "").replace(", -1e9)", "")},
  {_NUMBERS.replace("coalesce(", "").replace(", -1e9)", "")},
  {rnd("coalesce((wc.y - coalesce(fc.y, 0) + 20 * r) / (wc.n - coalesce(fc.n, 0) + 20), r)")} as prod_group_name_rate
from folded join oc on true left join wc on wc.g is not distinct from prod_group_name
left join fc on fc.g is not distinct from prod_group_name and fc.fold = folded.fold"""


def _lit(x: float) -> str:
    return f"cast({float(x)!r} as double)"


def _scorer_parts(scorer):
    c = rnd(f"{_lit(scorer.intercept)} + {_lit(scorer.frequency_weight)} * "
            f"ln(1.0 + coalesce(cast(total_purchases as double), 0.0))", 9)
    g = rnd(f"{_lit(scorer.popularity_weight)} * ln(1.0 + coalesce(cast(popularity as double), 0.0))", 9)
    return c, g


def _bonus(scorer, match_expr) -> str:
    """The largest weight of a match; without a scorer the weights are those of the table fw."""
    weight = lambda f: (_lit(scorer.match_weights.get(f.attribute, 0.0)) if scorer
                        else f"(select weight from fw where attribute = '{f.attribute}')")
    terms = [f"case when {match_expr(f)} then {weight(f)} else 0.0 end" for f in FAVOURITES]
    return f"greatest(0.0, {', '.join(terms)})"


def scored_cte(scorer) -> str:
    c, g = _scorer_parts(scorer)
    bonus = _bonus(scorer, lambda f: f.match)
    return f"""scored as (select *, {rnd(c + ' + ' + g + ' + ' + bonus, 9)} as logit from pairs),
scored2 as (select *, 1.0 / (1.0 + exp(-logit)) as probability from scored)"""


def weights_cte() -> str:
    """ln of the odds that a bought and a drawn pair match, at least 0."""
    share = lambda f, y: (f"((count(*) filter (where {f.match} and link_pred_baseline_target = {y}) + 1.0) / "  # noqa: E731
                          f"(count(*) filter (where link_pred_baseline_target = {y}) + 2.0))")
    return "fw as (" + " union all ".join(
        f"select '{f.attribute}' as attribute, {rnd(f'greatest(0.0, ln({share(f, 1)} / {share(f, 0)}))')} as weight "
        f"from pairs where split = 'train'" for f in FAVOURITES) + ")"


def topk_cte(scorer, k: int = 12, fitted: bool = False) -> str:
    c, g = _scorer_parts(scorer)
    scorer = None if fitted else scorer
    tops = ", ".join(f"cwf.{f.top}" for f in FAVOURITES)
    attrs = ", ".join(f"p.{f.attribute}" for f in FAVOURITES)
    bonus = _bonus(scorer, lambda f: f"rc.{f.top} = pb.{f.attribute}")
    return f"""asked as (select {ref('c_custkey')} as customer_id from customer
          union all select {ref('c_custkey')} from customer where c_custkey % 40 = 1),
req as (select distinct customer_id from asked),
rc as (select req.customer_id, {c} as c, {tops} from req left join cwf using (customer_id)),
pb as (select p.product_id, {attrs}, {g} as g from products p left join pf using (product_id)),
allpairs as (select rc.customer_id, pb.product_id, pb.g, {rnd('rc.c + pb.g + ' + bonus, 9)} as logit
             from rc cross join pb),
ranked as (select customer_id, product_id, logit,
           row_number() over (partition by customer_id order by logit desc, g desc, product_id asc) as rank
           from allpairs where logit >= 0),
topk as (select customer_id, cast(rank as integer) as rank, product_id, logit, 1.0 / (1.0 + exp(-logit)) as probability
         from ranked where rank <= {k}),
recs as (select r.customer_id,
         '[' || coalesce((select string_agg(cast(t.product_id as varchar), ' ' order by t.rank)
                           from topk t where t.customer_id = r.customer_id), '') || ']' as list_product_id
         from asked r)"""


def _confusion_cte() -> str:
    return f"""conf as (select split, count(*) as n,
  count(*) filter (where probability >= 0.5 and link_pred_baseline_target = 1) as tp,
  count(*) filter (where probability >= 0.5 and link_pred_baseline_target = 0) as fp,
  count(*) filter (where probability < 0.5 and link_pred_baseline_target = 1) as fn,
  count(*) filter (where probability < 0.5 and link_pred_baseline_target = 0) as tn
  from scored2 group by split),
confm as (select *, case when n > 0 then (tp + tn) / n else 0.0 end as accuracy,
          case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as precision,
          case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall,
          case when n > 0 then (tp + fn) / n else 0.0 end as prevalence from conf),
confx as (select split, n, tp, fp, fn, tn, cast(accuracy as double) as accuracy, cast(precision as double) as precision,
          cast(recall as double) as recall,
          cast(recall * precision + (1 - recall) * prevalence as double) as average_precision_hard from confm)"""


def _ranking_cte() -> str:
    return """ps as (select split, logit, cast(sum(link_pred_baseline_target) as double) as pos,
             cast(sum(1 - link_pred_baseline_target) as double) as neg from scored2 group by split, logit),
cum as (select *,
        coalesce(sum(neg) over (partition by split order by logit rows between unbounded preceding and 1 preceding), 0) as neg_below,
        sum(pos) over (partition by split order by logit desc rows between unbounded preceding and current row) as tp_ge,
        sum(pos + neg) over (partition by split order by logit desc rows between unbounded preceding and current row) as n_ge
        from ps),
tot as (select split, sum(pos) as P, sum(neg) as N from ps group by split),
rankm as (select split,
          case when max(P) * max(N) > 0 then sum(pos * (neg_below + neg / 2)) / (max(P) * max(N)) end as auc_roc,
          case when max(P) > 0 then sum(case when pos > 0 then pos * tp_ge / n_ge else 0 end) / max(P) else 0.0 end
            as average_precision_ranked
          from cum join tot using (split) group by split)"""


def queries(scorer=None) -> dict[str, str]:
    scorer = scorer or SCORER
    rr = lambda c: f"{rnd(c)} as {c}"
    training = f"with {FEATURE_CTES},\n{LABEL_CTES},\n{PAIRS_CTE}\n"
    scoring = f"with {FEATURE_CTES},\n{LABEL_CTES},\n{PAIRS_CTE},\n{scored_cte(scorer)}"
    metric_names = ["accuracy", "precision", "recall", "average_precision_hard", "auc_roc", "average_precision_ranked"]
    report = " union all ".join(f"select split, '{m}' as metric, {rnd(m)} as value from allm"
                                for m in metric_names)
    return {
        "typed_customers": CUSTOMERS,
        "typed_products": PRODUCTS,
        "encoded_customers": f"with {BASE_CTES}\nselect * from enc",
        "transactions": TRANSACTIONS,
        "expanded_transactions": expanded_transactions(),
        "attribute_counts": attribute_counts(),
        "favourites": favourites(True),
        "favourites_observed": favourites(False),
        "favourites_rownumber": favourites_rownumber(),
        "customer_rfm": customer_rfm(),
        "product_price_stats": product_price_stats(),
        "product_buyer_stats": product_buyer_stats(),
        "customer_features": customer_features(),
        "product_features": product_features(),
        "customers_with_features": f"with {FEATURE_CTES}\nselect {rounded_star(CUSTOMER_DOUBLES, DATES)} from cwf",
        "products_with_features": f"with {FEATURE_CTES}\nselect {rounded_star(PRODUCT_DOUBLES)} from pwf",
        "product_numbering": f"with {BASE_CTES}, {NUMBERING_CTE}\nselect * from numbered",
        "label_positives": f"with {BASE_CTES}, {POSITIVES_CTE}\nselect *, 1 as link_pred_baseline_target from positives",
        "label_negatives": f"with {BASE_CTES}, {LABEL_CTES}\nselect *, 0 as link_pred_baseline_target from negatives",
        "label_negatives_strict": f"with {BASE_CTES}, {LABEL_CTES},\n{STRICT_CTE}\n"
                                  f"select *, 0 as link_pred_baseline_target from strict",
        "labelled_pairs": f"with {BASE_CTES}, {LABEL_CTES}\nselect * from labelled",
        "pair_features": training + f"select split, time_date, customer_id, product_id, item_key, "
                                    f"link_pred_baseline_target, {MATCHES}, {RDIFFS} from pairs",
        "training_set": training + f"select {rounded_star(TRAINING_DOUBLES, DATES)} from (select {TRAINING_SELECT} from pairs)",
        "topk": f"with {FEATURE_CTES},\n{topk_cte(scorer)}\nselect customer_id, rank, product_id, "
                f"{rr('logit')}, {rr('probability')} from topk",
        "recommendations": f"with {FEATURE_CTES},\n{topk_cte(scorer)}\nselect * from recs",
        "submission": f"with {FEATURE_CTES},\n{topk_cte(scorer)}\nselect * from recs",
        "parsed_predictions": f"with {FEATURE_CTES},\n{topk_cte(scorer)}\nselect * from recs",
        "customer_features_as_of": customer_features().replace(
            f"tx as ({TRANSACTIONS})", f"tx as (select * from ({TRANSACTIONS}) where time_date < date '{SPLIT_DATE}')"),
        "fitted_weights": training + f", {weights_cte()}\nselect * from fw",
        "recommendations_fitted": training + f", {weights_cte()},\n{topk_cte(scorer, fitted=True)}\nselect * from recs",
        "parsed_text": """
select c_custkey as customer_id, case when c_custkey % 3 = 0 then null else cast(cast(c_acctbal as decimal(12, 2)) as double) end as n,
       case when c_custkey % 5 <> 0 then c_mktsegment when c_custkey % 7 = 4 then 'NONE' when c_custkey % 7 = 6 then '12x' end as s,
       case when c_custkey % 4 <> 0 then concat('2020-0', cast(1 + c_custkey % 9 as varchar), '-15') end as d
from customer""",
        "csv_customers": CUSTOMERS,
        "csv_products": PRODUCTS,
        "csv_transactions": TRANSACTIONS,
        "csv_requests": f"""
select {ref('c_custkey')} as customer_id from customer
union all select {ref('c_custkey')} from customer where c_custkey % 40 = 1""",
        "csv_label_lists": """
with l as (select case when p_partkey % 11 <> 0 then cast(cast(date '2020-01-01' + cast(p_size as integer) as date) as varchar) end as time_date,
    p_partkey, cast(p_size as bigint) as size, p_partkey % 10 = 0 as none from part)
select time_date, 'val' as split, p_partkey as customer_id, p_partkey as product_id, '0' as item_key from l where not none
union all select time_date, 'val', p_partkey, size, '1' from l where not none
union all select time_date, 'val', p_partkey, null, '' from l where none""",
        "exploded_lists": """
select p_partkey as customer_id, p_partkey as product_id, '0' as item_key from part where p_partkey % 10 <> 0
union all select p_partkey, cast(p_size as bigint), '1' from part where p_partkey % 10 <> 0
union all select p_partkey, p_partkey, '2' from part where p_partkey % 10 <> 0
union all select p_partkey, null, '' from part where p_partkey % 10 = 0""",
        "model_inputs": training + MODEL_INPUTS,
        "boost_inputs": training + BOOST_INPUTS,
        "scored_pairs": scoring + f"\nselect split, time_date, customer_id, product_id, link_pred_baseline_target, "
                                  f"{rr('logit')}, {rr('probability')} from scored2",
        "confusion_metrics": scoring + f",\n{_confusion_cte()}\nselect split, n, tp, fp, fn, tn, {rr('accuracy')}, "
                                       f"{rr('precision')}, {rr('recall')}, {rr('average_precision_hard')} from confx",
        "ranking_metrics": scoring + f",\n{_ranking_cte()}\nselect split, {rr('auc_roc')}, "
                                     f"{rr('average_precision_ranked')} from rankm",
        "evaluation_report": scoring + f",\n{_confusion_cte()},\n{_ranking_cte()},\n"
                                       f"allm as (select * from confx join rankm using (split))\n{report}",
    }
