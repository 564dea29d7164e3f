"""One query per operator, on the test tables. ``oracles.py`` says the same in SQL under the same name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefeatures.functions import rows as R
from casefeatures.functions import schema as S
from casefeatures.operators import aggregates as A
from casefeatures.operators import encode as E
from casefeatures.operators import joins as J
from casefeatures.operators import sequence
from casefeatures.operators.hotgroups import exact_median, exact_mode, row_numbers
from casefeatures.operators.sequence import group_features, peak_places, sequence_features
from casefeatures.checks import casetables
from casefeatures.plans import assemble
from casefeatures.plans import rollup as P
from casefeatures.plans.spec import TableSpec
from casefeatures.plans.tables import SPECS
from casefeatures.sources import files
from casefeatures.training import scores, trees, weights

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return files.scan_parquet(spark, f"{d}/{name}.parquet")


def fixed4(c: Column) -> Column:
    """Four decimals, cut where neat decimals do not fall, so that sums in another order compare equal."""
    return F.floor(c * 10000 + 0.37) / 10000


# --- stand-ins ---------------------------------------------------------------------------------


def case_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders as depth-1 rows: nullable price p, signed value s, its zero-floored half z, dates."""
    o, day = table(spark, d, "orders"), F.col("o_orderdate").cast("date")
    p = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return o.select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", day.alias("day"), "o_totalprice",
        p.alias("p"),
        (p - 250000).alias("s"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(0.0)).otherwise(p).alias("z"),
        F.when(F.col("o_orderstatus") == "F", day).alias("fday"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_add(day, (F.col("o_orderkey") % 90).cast("int"))).alias("until"),
        (F.col("o_orderkey") % 5).cast("int").alias("code"),
    )


def case_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines as depth-2 rows below an order."""
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_tax",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("disc"),
        F.col("l_shipdate").cast("date").alias("ship"),
    )


def case_events(spark: SparkSession, d: str) -> DataFrame:
    v = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", v.alias("v"), "value")


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents: target quality, categories lang and source; the source stands for the week."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return table(spark, d, "labels").join(docs, "doc_id")


def category_lookup(spark: SparkSession, d: str) -> DataFrame:
    fit = files.checkpointed(E.fit_encodings(labelled(spark, d), ["lang", "source"], "quality"))
    return E.with_ordinals(fit)


# --- sources and sinks -------------------------------------------------------------------------


@query
def scan_parquet(spark, d):
    return files.scan_parquet(spark, f"{d}/customer.parquet").select("c_custkey", "c_mktsegment", "c_acctbal")


@query
def scan_parts(spark, d):
    lines, path = table(spark, d, "lineitem"), files.scratch_path(spark, "parts")
    low = lines.filter("l_linenumber <= 3").select("l_orderkey", F.col("l_quantity").cast("int").alias("qty"), "l_returnflag")
    high = lines.filter("l_linenumber > 3").select(F.col("l_orderkey").cast("string").alias("l_orderkey"), F.col("l_quantity").alias("qty"), "l_returnflag")
    files.sink_parquet(low, f"{path}/lines_1.parquet")
    files.sink_parquet(high, f"{path}/lines_2.parquet")
    parts = files.scan_parts(spark, f"{path}/lines_*.parquet")
    return parts.groupBy("l_returnflag").agg(
        F.count("l_orderkey").alias("n"), F.sum("qty").alias("qty"), F.sum(F.col("l_orderkey").cast("bigint")).alias("keys")
    )


@query
def scan_csv(spark, d):
    path = files.scratch_path(spark, "supplier-csv")
    supplier = table(spark, d, "supplier")
    supplier.write.csv(path, header=True)
    return files.scan_csv(spark, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")


@query
def sink_parquet(spark, d):
    path = files.scratch_path(spark, "orders-by-customer")
    files.sink_parquet(table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top")), path)
    return files.scan_parquet(spark, path)


# --- schema ------------------------------------------------------------------------------------


@query
def cast_by_suffix(spark, d):
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("int").alias("case_id"),
        F.col("o_totalprice").cast("string").alias("price_1A"),
        (F.col("o_custkey") % 7).cast("int").alias("late_2P"),
        F.col("o_orderdate").alias("ordered_3D"),
        F.col("o_custkey").alias("customer_4M"),
        F.col("o_orderstatus").alias("status_5L"),
    )
    return S.cast_by_suffix(o)


@query
def lenient_cast(spark, d):
    word = F.when(F.col("c_nationkey") % 3 == 0, F.col("c_mktsegment")).otherwise(F.col("c_nationkey").cast("string"))
    return table(spark, d, "customer").select("c_custkey", S.lenient_cast(word, "int").alias("number"), S.lenient_cast(F.substring("c_name", 10, 20), "bigint").alias("n"))


@query
def strict_cast(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.strict_cast(F.col("o_custkey") % 30000, "smallint").cast("int").alias("small"))


@query
def bool_to_int(spark, d):
    rich = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal") > 5000)
    return table(spark, d, "customer").select("c_custkey", S.bool_to_int(rich).cast("int").alias("rich"), S.bool_to_int(rich, -1).cast("int").alias("rich_filled"))


@query
def parse_date(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.parse_date(F.substring(F.col("o_orderdate").cast("string"), 1, 10)).alias("day"))


@query
def narrow_types(spark, d):
    keys = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    slim = S.narrow_types(keys, keep=("l_orderkey",))
    return slim.select(*[F.col(c).cast("bigint").alias(c) for c in slim.columns])


@query
def pick_columns(spark, d):
    lines = table(spark, d, "lineitem")
    picked = S.pick_columns(lines, S.NUMERIC_TYPES, prefix="l_", without_suffixes=("key", "number"))
    return lines.groupBy("l_linestatus").agg(*[F.max(c).alias(c) for c in picked])


# --- projection and filter ---------------------------------------------------------------------


@query
def derive(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax")
    return R.derive(lines, {"l_tax": F.col("l_tax") * 2, "double_qty": F.col("l_quantity") + F.col("l_quantity")})


@query
def drop_columns(spark, d):
    return R.drop_columns(table(spark, d, "part"), ["p_name", "p_brand", "no_such_column"])


@query
def rename_columns(spark, d):
    return R.rename_columns(table(spark, d, "nation"), {"n_name": "name", "n_regionkey": "region"})


@query
def project_join_side(spark, d):
    side = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return J.join_one(table(spark, d, "orders").select("o_orderkey", "o_custkey"), side, "o_custkey", "left")


@query
def drop_all_null_rows(spark, d):
    o = case_orders(spark, d).select("o_orderkey", "p", "fday", "until")
    return R.drop_all_null_rows(o, ["p", "fday", "until"])


@query
def fill_null(spark, d):
    return case_orders(spark, d).select("o_orderkey", R.fill_null(F.col("p"), 0.0).alias("p"))


@query
def nan_to_null(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("disc")
    )
    return R.all_nan_to_null(lines)


@query
def sentinel_to_null(spark, d):
    return table(spark, d, "customer").select("c_custkey", R.sentinel_to_null(F.col("c_mktsegment"), "BUILDING").alias("segment"))


@query
def remap_values(spark, d):
    return case_orders(spark, d).select("o_orderkey", R.remap_values(F.col("o_orderstatus"), {"F": 0, "O": 1}, -1).alias("status"))


# --- category encoding -------------------------------------------------------------------------


def _encoded(spark, d, kinds: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    lookup = category_lookup(spark, d)
    return E.encode(docs, lookup, [E.fitted("lang", kinds=kinds), E.fitted("source", kinds=kinds)]).drop("lang", "source")


@query
def fit_encodings(spark, d):
    fit = E.fit_encodings(labelled(spark, d), ["lang", "source"], "quality")
    return fit.withColumn("mean_target", fixed4(F.col("mean_target")))


@query
def encode_mean_target(spark, d):
    out = _encoded(spark, d, "m")
    return out.select("doc_id", *[fixed4(F.col(c)).alias(c) for c in ("lang_mean_target", "source_mean_target")])


@query
def encode_frequency(spark, d):
    return _encoded(spark, d, "f")


@query
def encode_ordinal(spark, d):
    return _encoded(spark, d, "o")


PRIORITY_RANKS = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 1, "4-NOT SPECIFIED": 2}
PRIORITY_DAYS = {"1-URGENT": 1.5, "2-HIGH": 3, "3-MEDIUM": 7, "5-LOW": 30}


@query
def encode_hand_ranked(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    lookup = E.given_values(spark, {"o_orderpriority": PRIORITY_RANKS})
    out = E.encode(o, lookup, [E.valued("o_orderpriority", "rank")])
    return out.select("o_orderkey", F.col("rank").cast("int").alias("rank"))


@query
def encode_to_number(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    lookup = E.given_values(spark, {"o_orderpriority": PRIORITY_DAYS})
    return E.encode(o, lookup, [E.valued("o_orderpriority", "days")]).select("o_orderkey", "days")


@query
def encode_index(spark, d):
    lookup = E.index_categories(labelled(spark, d), "source")
    docs = table(spark, d, "documents").select("doc_id", "source")
    out = E.encode(docs, lookup, [E.valued("source", "source_id", default=0)])
    return out.select("doc_id", F.col("source_id").cast("int").alias("source_id"))


@query
def one_hot(spark, d):
    word = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return table(spark, d, "orders").select("o_orderkey", *R.one_hot(word, ["1-URGENT", "2-HIGH"], "priority", lambda v: v[0]))


@query
def value_flag(spark, d):
    return table(spark, d, "customer").select("c_custkey", R.value_flag(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), "MACHINERY").alias("is_machinery"))


@query
def null_flag(spark, d):
    return case_orders(spark, d).select("o_orderkey", R.null_flag(F.col("p")).alias("p_null"), R.null_flag(F.col("until")).alias("until_null"))


@query
def mean_of_encodings(spark, d):
    out = _encoded(spark, d, "m")
    mixed = R.mean_of_encodings(F.col("lang_mean_target"), F.col("source_mean_target"))
    return out.select("doc_id", fixed4(mixed).alias("mixed"))


@query
def frequency_share(spark, d):
    fit = E.fit_encodings(labelled(spark, d), ["lang", "source"], "quality")
    return E.frequency_share(fit).select("column", "category", fixed4(F.col("share")).alias("share"))


# --- row functions -----------------------------------------------------------------------------


@query
def split_first(spark, d):
    word = F.translate(F.col("o_orderpriority"), "- ", "__")
    return table(spark, d, "orders").select("o_orderkey", R.split_first(word, missing="5_LOW").alias("first_part"))


@query
def digits_to_int(spark, d):
    mixed = F.concat_ws("", (F.col("s_suppkey") % 50).cast("string"), F.lit("x"), F.col("s_nationkey").cast("string"), F.when(F.col("s_nationkey") % 4 == 0, F.lit("y")))
    return table(spark, d, "supplier").select("s_suppkey", R.digits_to_int(mixed).alias("digits"), R.digits_to_int(F.col("s_name")).alias("named"))


@query
def days_between(spark, d):
    return case_orders(spark, d).select("o_orderkey", R.days_between(F.col("until"), F.col("day")).alias("days"), R.days_between(F.col("fday"), F.lit("1998-01-01").cast("date")).alias("since"))


@query
def days_before_ref(spark, d):
    o = case_orders(spark, d).select("o_orderkey", F.lit("1999-06-30").cast("date").alias("ref"), "day", "fday", "until")
    return R.days_before_ref(o, "ref", ["day", "fday", "until"])


@query
def date_parts(spark, d):
    return case_orders(spark, d).select("o_orderkey", *R.date_parts(F.col("day"), "day"), F.year("day").alias("day_year"))


@query
def make_month_date(spark, d):
    year, month = F.concat(F.year("day").cast("string"), F.lit(".0")), F.concat((F.month("day") + F.col("code") - 2).cast("string"), F.lit(".0"))
    return case_orders(spark, d).select("o_orderkey", R.make_month_date(year, month).alias("month_date"))


@query
def latest_of_columns(spark, d):
    return case_orders(spark, d).select("o_orderkey", R.latest_of_columns(F.col("fday"), F.col("until")).alias("latest"))


@query
def band_flags(spark, d):
    years = R.scale(R.days_between(F.lit("2020-01-01").cast("date"), F.date_sub(F.col("fday"), 9000)), 1.0 / 365)
    return case_orders(spark, d).select("o_orderkey", *R.band_flags(years, [25, 35, 45, 60], "age"))


@query
def scale(spark, d):
    return case_orders(spark, d).select("o_orderkey", R.scale(F.col("p"), 6.0).alias("times6"), fixed4(R.scale(F.col("code"), 1.0 / 365)).alias("years"))


@query
def in_list_flag(spark, d):
    word = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return table(spark, d, "orders").select("o_orderkey", R.in_list_flag(word, ["1-URGENT", "3-MEDIUM"]).alias("listed"))


@query
def safe_ratio(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", fixed4(R.safe_ratio(F.col("l_quantity"), F.col("l_discount"))).alias("ratio"))


# --- joins -------------------------------------------------------------------------------------


def _lines_by_order(spark, d) -> DataFrame:
    return case_lines(spark, d).groupBy(F.col("l_orderkey").alias("num_group1")).agg(
        A.count_nonnull(F.col("disc")).alias("n_disc"), F.max("l_quantity").alias("top_qty")
    )


def _orders_by_case(spark, d) -> DataFrame:
    return case_orders(spark, d).groupBy(F.col("o_custkey").alias("case_id")).agg(A.count_nonnull(F.col("p")).alias("n_p"), F.max("p").alias("top"))


def _base(spark, d) -> DataFrame:
    """Cases: customers. A fifth of them asks with a key no order has."""
    key = F.when(F.col("c_nationkey") % 5 == 0, -F.col("c_custkey") - 1).otherwise(F.col("c_custkey"))
    return table(spark, d, "customer").select(key.alias("case_id"), F.col("c_nationkey").cast("bigint").alias("WEEK_NUM"), (F.col("c_acctbal") > 5000).cast("int").alias("target"))


@query
def join_child_level(spark, d):
    o = case_orders(spark, d).select(F.col("o_custkey").alias("case_id"), F.col("o_orderkey").alias("num_group1"), "p")
    return J.join_child_level(o, _lines_by_order(spark, d), ["num_group1"])


@query
def join_base(spark, d):
    base, rolled = _base(spark, d), _orders_by_case(spark, d)
    kinds = [J.join_base(base, rolled, how).withColumn("how", F.lit(how)) for how in ("inner", "left")]
    return kinds[0].unionByName(kinds[1])


@query
def join_target(spark, d):
    features = _orders_by_case(spark, d).withColumnRenamed("top", "target")
    return J.join_target(features, _base(spark, d))


@query
def join_weights(spark, d):
    base = _base(spark, d)
    return J.join_weights(base, base.select("case_id", fixed4(F.col("WEEK_NUM") / 7).alias("weights")))


@query
def cases_left(spark, d):
    lines = case_lines(spark, d).select(F.col("l_partkey").alias("case_id")).distinct()
    return J.cases_left(_base(spark, d), {"orders": _orders_by_case(spark, d), "parts": lines})


# --- aggregations ------------------------------------------------------------------------------


def _by_customer(spark, d, *aggs: Column) -> DataFrame:
    return case_orders(spark, d).groupBy("o_custkey").agg(*aggs)


_p, _s, _z, _o = (lambda: F.col("p")), (lambda: F.col("s")), (lambda: F.col("z")), (lambda: F.col("o_orderkey"))


@query
def agg_count_nonnull(spark, d):
    return _by_customer(spark, d, A.count_nonnull(_p()).alias("num_p"), A.count_nonnull(F.col("until")).alias("num_until"))


@query
def agg_count_nonmissing(spark, d):
    return _by_customer(spark, d, A.count_nonmissing(F.col("o_orderpriority"), "5-LOW").alias("num_priority"))


@query
def agg_count_where(spark, d):
    return _by_customer(
        spark, d, A.count_where(_s() > 0).alias("num_pos"), A.count_where(_z() == 0).alias("num_zero"),
        A.count_where(F.col("until").isNotNull() & (_z() > 0)).alias("num_both"),
    )


@query
def agg_basic(spark, d):
    return _by_customer(
        spark, d, fixed4(A.total(_p())).alias("p_sum"), fixed4(F.avg(_p())).alias("p_mean"), F.min(_p()).alias("p_min"), F.max(_p()).alias("p_max")
    )


@query
def agg_positive(spark, d):
    made = {k: A.positive_stat(k, _s()) for k in ("max", "sum", "mean", "min", "std")}
    out = _by_customer(spark, d, *[fixed4(c).alias(f"s_{k}") for k, c in made.items()])
    positive = case_orders(spark, d).select("o_custkey", A.positive(_s()).alias("s"))
    middle = exact_median(positive, ["o_custkey"], "s", "s_median").select("o_custkey", fixed4(F.col("s_median")).alias("s_median"))
    return out.join(middle, "o_custkey", "left")


@query
def agg_median(spark, d):
    return exact_median(case_lines(spark, d), ["l_returnflag", "l_linestatus"], "l_extendedprice", "price_median").withColumn(
        "price_median", fixed4(F.col("price_median"))
    )


@query
def agg_where(spark, d):
    known = F.col("until").isNotNull()
    return _by_customer(
        spark, d, fixed4(A.sum_where(known, _p())).alias("open_sum"), A.min_where(known, F.col("day")).alias("first_open"),
        A.max_where(known, F.col("day")).alias("last_open"),
    )


@query
def agg_first(spark, d):
    return _by_customer(spark, d, A.first_value(_p(), _o()).alias("p_first"))


@query
def agg_first_nonnull(spark, d):
    return _by_customer(spark, d, A.first_nonnull(_p(), _o()).alias("p_first"))


@query
def agg_last(spark, d):
    return _by_customer(spark, d, A.last_value(_p(), _o()).alias("p_last"))


@query
def agg_last_nonnull(spark, d):
    return _by_customer(spark, d, A.last_nonnull(_p(), _o()).alias("p_last"), A.last_nonnull(F.col("until"), _o()).alias("until_last"))


@query
def agg_last_positive(spark, d):
    return _by_customer(spark, d, A.last_positive(_s(), _o()).alias("s_last"))


@query
def agg_argmax_pos(spark, d):
    return peak_places(case_orders(spark, d), ["o_custkey"], ["o_orderkey"], ["s", "z"])


@query
def agg_peak_drop(spark, d):
    return _by_customer(spark, d, fixed4(A.peak_drop(_z(), _o())).alias("z_pos"))


@query
def agg_mode(spark, d):
    return _by_customer(spark, d, A.mode_of(F.col("o_orderpriority")).alias("priority_mode"))


@query
def hot_mode(spark, d):
    """The same from counts per value, for columns of many values."""
    return exact_mode(case_orders(spark, d), ["o_custkey"], "o_orderpriority", "priority_mode")


@query
def agg_span(spark, d):
    return _by_customer(
        spark, d, fixed4(A.span(_p())).alias("p_span"), A.span_days(F.col("until")).alias("until_days"),
        (F.year(F.max("day")) - F.year(F.min("day"))).alias("years"),
    )


@query
def agg_gap(spark, d):
    return _by_customer(spark, d, fixed4(A.gap(F.col("o_totalprice"), _s())).alias("gap"))


@query
def agg_any_null(spark, d):
    return _by_customer(spark, d, A.any_null(_p()).alias("p_null"))


@query
def agg_ratio_of(spark, d):
    return _by_customer(
        spark, d, *[fixed4(A.ratio_of(k, _s(), _z())).alias(f"ratio_{k}") for k in ("max", "sum", "mean")]
    )


@query
def agg_of_ratio(spark, d):
    return _by_customer(spark, d, *[fixed4(A.of_ratio(k, _s(), _z())).alias(f"ratio_{k}") for k in ("max", "mean")])


@query
def agg_share(spark, d):
    return _by_customer(spark, d, fixed4(A.share(_z(), F.col("o_totalprice"))).alias("share"))


@query
def agg_diff_of(spark, d):
    return _by_customer(spark, d, *[fixed4(A.diff_of(k, _z(), _s())).alias(f"diff_{k}") for k in ("max", "sum", "mean")])


@query
def agg_of_diff(spark, d):
    return _by_customer(
        spark, d, fixed4(A.of_diff("max", _z(), _s())).alias("diff_max"), fixed4(A.of_diff("max", _s(), _z(), True)).alias("gap_max")
    )


@query
def agg_of_days(spark, d):
    made = {k: A.of_days(k, F.col("until"), F.col("day")) for k in ("min", "max", "mean", "std")}
    return _by_customer(spark, d, *[(fixed4(c) if k in ("mean", "std") else c).alias(f"days_{k}") for k, c in made.items()])


@query
def agg_days_of(spark, d):
    return _by_customer(spark, d, A.days_of(F.col("until"), F.col("fday")).alias("days"))


@query
def agg_days_norm(spark, d):
    ref = F.lit("1994-12-01").cast("date")
    return _by_customer(
        spark, d, *[fixed4(A.days_norm(k, F.col("until"), F.col("day"), F.col("day"), ref)).alias(f"norm_{k}") for k in ("mean", "std")]
    )


@query
def agg_date(spark, d):
    return _by_customer(
        spark, d, F.max("until").alias("until_max"), F.min("until").alias("until_min"), A.mean_date(F.col("until")).alias("until_mean")
    )


@query
def agg_date_std(spark, d):
    return _by_customer(spark, d, A.date_std(F.col("until")).alias("until_std"))


@query
def agg_recent_flag(spark, d):
    return _by_customer(spark, d, A.recent_flag(_s(), 20000.0).alias("s_recent"))


@query
def agg_rise_flag(spark, d):
    return _by_customer(spark, d, A.rise_flag(_p(), _o()).alias("p_rise"))


@query
def agg_first_last_ratio(spark, d):
    return _by_customer(spark, d, fixed4(A.first_last_ratio(_z(), _o())).alias("z_ratio"))


@query
def agg_onehot_sum(spark, d):
    return _by_customer(spark, d, *A.one_hot_sums(F.nullif(F.col("o_orderstatus"), F.lit("P")), ["F", "O"], "num_status"))


def _coded_orders(spark, d) -> DataFrame:
    o = case_orders(spark, d)
    return o.select(
        "o_custkey", "o_orderkey", _p().alias("a_mean_target"), F.col("o_totalprice").alias("b_mean_target"), F.col("code").alias("c_encoded"),
        F.when(F.col("o_orderstatus") != "P", F.month("day")).alias("d_encoded"), F.col("code").cast("bigint").alias("e_frequency"),
    )


@query
def agg_encodings(spark, d):
    o = _coded_orders(spark, d)
    made = P.agg_encodings(o.columns, ("_mean_target", "_frequency"), ("_encoded",), _o())
    return o.groupBy("o_custkey").agg(*[(c if "_encoded" in n else fixed4(c)).alias(n) for n, c in made.items()])


@query
def agg_by_name_rule(spark, d):
    rolled = case_lines(spark, d).groupBy("l_orderkey").agg(
        A.count_nonnull(F.col("disc")).alias("num_disc"), F.min("l_quantity").alias("qty_first"), F.max("l_quantity").alias("qty_last"),
        A.span_days(F.col("ship")).alias("ship_duration"), (F.max("l_quantity") - F.min("l_quantity")).alias("qty_diff"),
    )
    o = table(spark, d, "orders").select("o_custkey", F.col("o_orderkey").alias("l_orderkey")).join(rolled, "l_orderkey", "left")
    made = P.agg_by_name_rule(o.columns)
    return o.groupBy("o_custkey").agg(*[(fixed4(c) if n.endswith("_mean") else c).alias(n) for n, c in made.items()])


# --- sequences ---------------------------------------------------------------------------------


def _sequence(spark, d, kind: str) -> DataFrame:
    ev = sequence_features(case_events(spark, d), ["user_id"], ["ts", "event_id"], ["v", "value"], [kind])
    return ev.select("user_id", *[fixed4(F.col(f"{c}_{kind}")).alias(f"{c}_{kind}") for c in ("v", "value")])


@query
def seq_tail_mean(spark, d):
    return _sequence(spark, d, "tail_mean")


@query
def seq_tail_max(spark, d):
    return _sequence(spark, d, "tail_max")


@query
def seq_diff_mean(spark, d):
    return _sequence(spark, d, "diffmean")


@query
def seq_diff_std(spark, d):
    return _sequence(spark, d, "diffstd")


@query
def seq_diff_last(spark, d):
    return _sequence(spark, d, "difflast")


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query
def seq_lines(spark, d):
    """All sequence features of several columns at once, per order."""
    columns, kinds = ["disc", "l_quantity", "l_extendedprice"], ["tail_mean", "tail_max", "diffmean", "diffstd", "difflast"]
    out = sequence_features(case_lines(spark, d), ["l_orderkey"], LINE_ORDER, columns, kinds)
    return out.select("l_orderkey", *[fixed4(F.col(c)).alias(c) for c in out.columns if c != "l_orderkey"])


# --- hot groups: a third of all rows and more in one key, cut into pieces --------------------------


def _hot_events(spark, d) -> DataFrame:
    """Every third user's events belong to user 0."""
    ev = case_events(spark, d)
    return ev.withColumn("user_id", F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")))


@query
def hot_sequence(spark, d):
    kinds = ["tail_mean", "tail_max", "diffmean", "diffstd", "difflast"]
    out = group_features(
        _hot_events(spark, d), ["user_id"], ["ts", "event_id"], [F.count(F.lit(1)).alias("n")], ["v"], kinds, ["v"], [(F.col("v"), "v_median")], limit=500
    )
    return out.select("user_id", "n", "v_maxidx", *[fixed4(F.col(f"v_{k}")).alias(f"v_{k}") for k in (*kinds, "median")])


@query
def hot_row_numbers(spark, d):
    ev = _hot_events(spark, d).select("user_id", "event_id", "ts")
    whole = row_numbers(ev, [], ["ts", "event_id"], "place", limit=1000)
    return row_numbers(whole, ["user_id"], ["ts", "event_id"], "place_of_user", limit=500).drop("ts")


@query
def order_ties(spark, d):
    return sequence.order_ties(table(spark, d, "lineitem"), ["l_suppkey"], ["l_shipdate"])


@query
def order_report(spark, d):
    """Two tables of the job, one of them with only four numbers for its depth-1 rows."""
    tables = {n: casetables.case_table(spark, d, n) for n in ("deposit_1", "debitcard_1")}
    tables["debitcard_1"] = tables["debitcard_1"].withColumn("num_group1", F.col("num_group1") % 4)
    return assemble.order_report(tables)


@query
def hot_auc(spark, d):
    return scores.weighted_auc(_scored(spark, d), "score", "target", "weight", limit=100).select(fixed4(F.col("auc")).alias("auc"))


# --- whole jobs --------------------------------------------------------------------------------


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[fixed4(S.quoted(f.name)).alias(f.name) if isinstance(f.dataType, S.FLOAT_TYPES) else S.quoted(f.name) for f in df.schema.fields])


def _rolled(spark, d, name: str) -> DataFrame:
    """The roll-up of one detail table made from the test tables."""
    spec, df = SPECS[name], casetables.case_table(spark, d, name)
    lookup = _lookup_for(spark, d, name) if spec.categories else None
    if spec.depth == 2:
        return P.rollup_depth2(df, spec, lookup)
    if spec.depth == 0:
        return P.static_table(df, spec, lookup)
    return P.rollup_depth1(df, spec, lookup, _rolled(spark, d, spec.child) if spec.child else None)


def _lookup_for(spark, d, name: str) -> DataFrame:
    return assemble.fit_lookups({"base": casetables.case_table(spark, d, "base"), name: casetables.case_table(spark, d, name)})


PLAIN_TABLES = ("debitcard_1", "deposit_1", "tax_registry_a_1", "tax_registry_b_1", "tax_registry_c_1", "other_1", "credit_bureau_b_2")


def _as_doubles(df: DataFrame) -> DataFrame:
    """All numbers but the keys as rounded doubles."""
    numbers = {f.name for f in df.schema.fields if isinstance(f.dataType, (*S.NUMERIC_TYPES, T.BooleanType))} - set(S.KEY_COLUMNS)
    return df.selectExpr(*[f"floor(CAST(`{n}` AS DOUBLE) * 10000 + 0.37D) / 10000 AS `{n}`" if n in numbers else f"`{n}`" for n in df.columns])


def _register_table(name: str) -> None:
    def run(spark, d):
        out = _rolled(spark, d, name)
        return _rounded(out) if name in PLAIN_TABLES else _as_doubles(out)

    run.__name__ = f"table_{name}"
    query(run)


for _name in SPECS:
    _register_table(_name)


@query
def rollup_depth2(spark, d):
    """Lines of an order, reduced by a spec."""
    lines = table(spark, d, "lineitem").select(
        F.lit(0).alias("case_id"), F.col("l_orderkey").alias("num_group1"), casetables.line_number().alias("num_group2"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("disc_1A"), F.col("l_quantity").alias("qty_2A"), F.col("l_shipdate").alias("ship_3D"),
        F.col("l_returnflag").alias("flag_4M"),
    )
    out = P.rollup_depth2(lines, LINES_SPEC, E.given_values(spark, {"flag_4M": {"A": 0, "N": 1, "R": 2}}))
    return _rounded(out.drop("case_id"))


LINES_SPEC = TableSpec(
    name="lines", depth=2,
    categories=(E.valued("flag_4M", "flag_4M_encoded"),),
    counts=("disc_1A",), stats={"disc_1A_sum": ("sum", "disc_1A"), "qty_2A_max": ("max", "qty_2A")},
    span_days={"ship_3D_duration": "ship_3D"}, last={"qty_2A_last": "qty_2A"}, peaks=("qty_2A",),
    order_endings=("_encoded",), sequences=True,
)


@query
def rollup_depth1(spark, d):
    """Orders of a case with their rolled-up lines, reduced by a spec."""
    o = case_orders(spark, d).select(F.col("o_custkey").alias("case_id"), F.col("o_orderkey").alias("num_group1"), F.col("p").alias("price_1A"), F.col("day").alias("day_2D"))
    lines = case_lines(spark, d).groupBy(F.col("l_orderkey").alias("num_group1")).agg(F.count("disc").alias("num_disc"), F.max("l_quantity").alias("qty_last"))
    child = o.select("case_id", "num_group1").join(lines, "num_group1")
    return _rounded(P.rollup_depth1(o, ORDERS_SPEC, None, child))


ORDERS_SPEC = TableSpec(
    name="orders", depth=1, counts=("price_1A",), positive={"max": ("price_1A",), "sum": ("price_1A",)}, medians=("price_1A",),
    dates={"day_2D_last": ("max", "day_2D")}, name_rules=True, sequences=True,
)


@query
def encode_table(spark, d):
    spec = SPECS["credit_bureau_b_1"]
    rows = P.encode_table(S.cast_by_suffix(casetables.case_table(spark, d, spec.name)), spec, _lookup_for(spark, d, spec.name))
    return _as_doubles(rows)


@query
def assemble_features(spark, d):
    tables = casetables.case_tables(spark, d)
    keep = assemble.stored_under(files.scratch_path(spark, "rollups"))
    return _narrowed(assemble.assemble_features(tables, "train", keep=keep, narrow=False))


def _narrowed(df: DataFrame) -> DataFrame:
    """A stored table with its doubles cut to four decimals and all numbers narrowed, shown as doubles."""
    real = {f.name for f in df.schema.fields if isinstance(f.dataType, S.FLOAT_TYPES)}
    out = S.narrow_types(df.selectExpr(*[f"floor(`{n}` * 10000 + 0.37D) / 10000 AS `{n}`" if n in real else f"`{n}`" for n in df.columns]))
    numbers = {f.name for f in out.schema.fields if isinstance(f.dataType, (*S.NUMERIC_TYPES, T.BooleanType))} - {"case_id"}
    return out.selectExpr(*[f"CAST(`{n}` AS DOUBLE) AS `{n}`" if n in numbers else f"`{n}`" for n in out.columns])


@query
def prune_features(spark, d):
    o = case_orders(spark, d).select("o_orderkey", _p().alias("a_mean_target"), F.col("code").alias("b_encoded_mode"), F.col("code").alias("c_encoded_last"), "z")
    return assemble.prune_features(o, weak=["z"], listed=["no_such_column"])


# --- training ----------------------------------------------------------------------------------


def _weeks(spark, d) -> DataFrame:
    return labelled(spark, d).select(F.col("doc_id").alias("case_id"), F.col("source").alias("WEEK_NUM"), F.col("quality").alias("target"), "lang", "n_chars", "toxic")


@query
def class_weight_by_group(spark, d):
    out = weights.class_weight_by_group(_weeks(spark, d))
    return out.select("case_id", "WEEK_NUM", "target", fixed4(F.col("weights")).alias("weights"))


@query
def split_roles(spark, d):
    data = _weeks(spark, d)
    features, roles = weights.split_roles(data.columns)
    return data.select(*features, *[r for r in roles if r == "case_id"])


@query
def stratified_group_folds(spark, d):
    """Per class: no group in two folds, and every fold's share within the largest group's share and a twentieth of an even one."""
    folds = 5
    out = weights.stratified_group_folds(_weeks(spark, d), folds=folds)
    counts = out.groupBy("target", "WEEK_NUM").agg(F.countDistinct("fold").alias("k"), F.min("fold").alias("fold"), F.count("fold").alias("n"))
    shares = [F.sum(F.when(F.col("fold") == i, F.col("n")).otherwise(0)) / F.sum("n") for i in range(folds)]
    apart = F.greatest(*[F.abs(s - 1 / folds) for s in shares])
    even = apart <= F.max("n") / F.sum("n") + 0.05
    return counts.groupBy("target").agg(F.max("k").alias("folds_per_group"), F.sum("n").alias("rows_dealt"), even.alias("even"))


def _scored(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey", (F.floor(F.col("o_totalprice") / 1000) / 1000).alias("score"), (F.col("o_orderkey") * 7 % 10 < 3).cast("int").alias("target"),
        (F.col("o_custkey") % 5).cast("double").alias("weight"), (F.col("o_custkey") % 4).cast("int").alias("fold"),
    )


@query
def weighted_auc(spark, d):
    return scores.weighted_auc(_scored(spark, d), "score", "target", "weight").select(fixed4(F.col("auc")).alias("auc"))


@query
def auc(spark, d):
    return scores.auc(_scored(spark, d), "score", "target").select(fixed4(F.col("auc")).alias("auc"))


@query
def cv_summary(spark, d):
    per_fold = scores.auc(_scored(spark, d), "score", "target", ["fold"])
    out = scores.cv_summary(per_fold)
    return out.select(F.size("scores").alias("folds"), fixed4(F.col("mean_score")).alias("mean_score"), fixed4(F.col("max_score")).alias("max_score"))


# A higher rate, fewer and flatter trees and less patience than the job's, so that all queries on models take minutes and trees run out.
TREES, TREE_PATIENCE = {"maxDepth": 2, "maxIter": 200, "stepSize": 0.1}, 20


def _model_rows(spark, d) -> tuple[DataFrame, trees.Features]:
    """Lines per order as rows, the year as week; the target follows from number of lines, discount and code, with noise from the order's number."""
    o = case_orders(spark, d)
    lines = case_lines(spark, d).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"), F.avg("disc").alias("disc"))
    noise = F.pmod(F.xxhash64("o_orderkey"), F.lit(1000)) / 1000 - 0.5
    signal = (F.coalesce("n_lines", F.lit(0)) - 4) * 0.15 + F.sin(F.coalesce("disc", F.lit(0)) * 60) * 0.4 + F.pmod("code", F.lit(3)) * 0.2 - 0.2 + noise
    data = o.join(lines, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("case_id"), F.year("day").cast("bigint").alias("WEEK_NUM"), (signal > 0).cast("int").alias("target"),
        "n_lines", "disc", F.col("code").alias("code_encoded"),
    )
    # Weights, folds, codes and fits all read these rows.
    data = weights.class_weight_by_group(files.checkpointed(data))
    data = weights.stratified_group_folds(data, folds=2)
    codes = trees.code_sizes(data, ["code_encoded"])
    return data, trees.Features(["n_lines", "disc"], codes)


def _models(spark, d):
    data, features = _model_rows(spark, d)
    data = files.checkpointed(data)
    return data, features, trees.train_boosted_trees(data, features, TREES, folds=2, patience=TREE_PATIENCE)


@query
def train_boosted_trees(spark, d):
    """Per fold: whether many trees were kept, and whether they rank its cases better than the best single column does."""
    data, features, models = _models(spark, d)
    found = trees.fold_scores(trees.predict_held_out(models, data, features), weight=None)
    for c in ("n_lines", "disc"):
        alone = scores.auc(data.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(-1.0))), c, "target", ["fold"])
        found = found.join(alone.withColumnRenamed("auc", f"_{c}"), "fold")
    best = F.greatest(*[F.greatest(F.col(f"_{c}"), 1 - F.col(f"_{c}")) for c in ("n_lines", "disc")])
    counts = trees.tree_counts(models)
    many = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, n)]), F.col("fold")) >= 50
    return found.select("fold", many.alias("many_trees"), (F.col("auc") >= best - 0.005).alias("as_good_as_best_column"))


@query
def predict_score(spark, d):
    """Every case scored once, within 0 and 1."""
    data, features, models = _models(spark, d)
    scored = trees.predict_held_out(models, data, features)
    return scored.agg(F.count("*").alias("n"), F.countDistinct("case_id").alias("cases"), F.count_if(F.col("score").between(0, 1)).alias("in_range"))


@query
def model_store(spark, d):
    data, features, models = _models(spark, d)
    path = files.scratch_path(spark, "models")
    trees.save_models(models, path)
    trees.save_names(spark, features.names, f"{path}-names")
    loaded = trees.load_models(path, 2)
    a = trees.predict_held_out(models, data, features).select("case_id", F.col("score").alias("before"))
    b = trees.predict_held_out(loaded, data, features).select("case_id", F.col("score").alias("after"))
    names = len(trees.load_names(spark, f"{path}-names"))
    return a.join(b, "case_id").agg(F.count_if(F.col("before") == F.col("after")).alias("same"), F.count(F.lit(1)).alias("n"), F.lit(names).alias("names"))


@query
def param_search(spark, d):
    """Trials by place: whether no later one is better, and whether the score is one."""
    data, features = _model_rows(spark, d)
    draws = trees.draw_params(2, {"maxDepth": (1, 3), "subsamplingRate": (0.5, 1.0)}, {"maxIter": 10, "stepSize": trees.SEARCH_PARAMS["stepSize"]})
    found = trees.param_search(data, features, draws, folds=2).collect()
    rows = [(i, all(r["mean_score"] >= x["mean_score"] for x in found[i:]), 0 <= r["mean_score"] <= 1) for i, r in enumerate(found)]
    return spark.createDataFrame(rows, "place int, best_of_rest boolean, in_range boolean")


@query
def feature_importance(spark, d):
    """Whether the splits of all folds' trees add up: a tree of n splits has n + 1 leaves; and whether the gains are shares."""
    _, features, models = _models(spark, d)
    nodes = sum(t.numNodes for m in models.values() for t in m.stages[-1].trees)
    total = sum(len(m.stages[-1].trees) for m in models.values())
    found = trees.feature_importance(spark, models, features)
    return found.agg(
        F.count("*").alias("features"), (F.sum("importance_split") == (nodes - total) // 2).alias("splits_add_up"), (F.abs(F.sum("importance_gain") - 1) < 1e-6).alias("gains_add_up")
    )


@query
def select_weak_features(spark, d):
    """Parts sold in few lines stand for features used in few splits."""
    path = files.scratch_path(spark, "importance-csv")
    used = case_lines(spark, d).groupBy(F.col("l_partkey").cast("string").alias("feature_name")).agg(F.count(F.lit(1)).alias("importance_split"))
    used.write.csv(path, header=True)
    return trees.select_weak_features(files.scan_csv(spark, path, "feature_name string, importance_split double"), 25)
