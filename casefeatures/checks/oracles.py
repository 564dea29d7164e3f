"""The queries of ``queries.py`` in SQL, under the same names."""

from __future__ import annotations

from collections.abc import Sequence

from casefeatures.checks.casetables import LINE_NUMBER, case_sql
from casefeatures.checks.queries import PRIORITY_DAYS, PRIORITY_RANKS
from casefeatures.checks.specsql import encoded_oracle, job_oracle, spec_oracle
from casefeatures.plans.tables import SPECS

ORACLES: dict[str, str] = {}


def f4(x: str) -> str:
    return f"floor(({x}) * 10000 + 0.37::DOUBLE) / 10000"


CASE_ORDERS = """co AS (
    SELECT *, p - 250000 AS s, CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0::DOUBLE ELSE p END AS z,
           CASE WHEN o_orderstatus = 'F' THEN day END AS fday,
           CASE WHEN o_orderpriority <> '5-LOW' THEN day + CAST(o_orderkey % 90 AS INTEGER) END AS until,
           CAST(o_orderkey % 5 AS INTEGER) AS code
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS p FROM orders))"""
CASE_LINES = "cl AS (SELECT *, nullif(l_discount, 0) AS disc, CAST(l_shipdate AS DATE) AS ship FROM lineitem)"
CASE_EVENTS = "ce AS (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)"
LABELLED = "lb AS (SELECT doc_id, quality, toxic, lang, source, n_chars FROM labels JOIN documents USING (doc_id))"
LOOKUP = f"""{LABELLED}, pairs AS (
    SELECT 'lang' AS "column", lang AS category, quality FROM lb UNION ALL SELECT 'source', source, quality FROM lb),
lk AS (SELECT "column", category, avg(quality) AS mean_target, count(*) AS frequency FROM pairs
       WHERE category IS NOT NULL GROUP BY 1, 2)"""
BASE = """base AS (
    SELECT CASE WHEN c_nationkey % 5 = 0 THEN -c_custkey - 1 ELSE c_custkey END AS case_id,
           CAST(c_nationkey AS BIGINT) AS "WEEK_NUM", CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS target FROM customer)"""
ROLLED = "rolled AS (SELECT o_custkey AS case_id, count(p) AS n_p, max(p) AS top FROM co GROUP BY 1)"


def oracle(name: str, *parts: str) -> None:
    """The last part is the SELECT, those before it are named subqueries."""
    ctes = ",\n".join(parts[:-1])
    ORACLES[name] = (f"WITH {ctes}\n" if ctes else "") + parts[-1]


def by_customer(name: str, **columns: str) -> None:
    listed = ",\n       ".join(f'{sql} AS "{n}"' for n, sql in columns.items())
    oracle(name, CASE_ORDERS, f"SELECT o_custkey, {listed} FROM co GROUP BY o_custkey")


def ordered(x: str, cond: str = "TRUE") -> str:
    return f"list({x} ORDER BY o_orderkey) FILTER (WHERE {cond})"


def sequence_sql(source: str, keys: Sequence[str], order: str, columns: Sequence[str], kinds: Sequence[str], whole: Sequence[str] = ()) -> tuple[str, str]:
    """Sequence features per key, from the rows of ``source``: numbered from the end, steps by lag. ``whole`` columns hold whole numbers."""
    key = ", ".join(keys)
    parts, joins, shown = [f"seq_keys AS (SELECT DISTINCT {key} FROM {source})"], "", []
    for i, c in enumerate(columns):
        parts.append(
            f"""seq_{i} AS (SELECT {key},
    avg(x) FILTER (WHERE r <= 3) AS tail_mean, max(x) FILTER (WHERE r <= 3) AS tail_max, avg(step) AS diffmean,
    stddev_samp(step) AS diffstd, max(step) FILTER (WHERE r = 1) AS difflast
FROM (SELECT {key}, "{c}" AS x, row_number() OVER (PARTITION BY {key} ORDER BY {order.replace(',', ' DESC,')} DESC) AS r,
             "{c}" - lag("{c}") OVER (PARTITION BY {key} ORDER BY {order}) AS step
      FROM {source} WHERE "{c}" IS NOT NULL) GROUP BY {key})"""
        )
        joins += f" LEFT JOIN seq_{i} USING ({key})"
        for k in kinds:
            x = f"seq_{i}.{k}"
            shown.append(f'{x if c in whole and k in ("difflast", "tail_max") else f4(x)} AS "{c}_{k}"')
    return ",\n".join(parts), f"SELECT {key}, {', '.join(shown)} FROM seq_keys{joins}"


# --- sources, schema, projection ---------------------------------------------------------------

oracle("scan_parquet", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
oracle("scan_parts", "SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS qty, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem GROUP BY 1")
oracle("scan_csv", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
oracle("sink_parquet", "SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1")
oracle(
    "cast_by_suffix",
    """SELECT CAST(o_orderkey AS BIGINT) AS case_id, o_totalprice AS "price_1A", CAST(o_custkey % 7 AS DOUBLE) AS "late_2P",
       CAST(o_orderdate AS DATE) AS "ordered_3D", CAST(o_custkey AS VARCHAR) AS "customer_4M", o_orderstatus AS "status_5L" FROM orders""",
)
oracle(
    "lenient_cast",
    """SELECT c_custkey, TRY_CAST(CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment ELSE CAST(c_nationkey AS VARCHAR) END AS INTEGER) AS number,
       TRY_CAST(substring(c_name, 10, 20) AS BIGINT) AS n FROM customer""",
)
oracle("strict_cast", "SELECT o_orderkey, CAST(CAST(o_custkey % 30000 AS SMALLINT) AS INTEGER) AS small FROM orders")
oracle(
    "bool_to_int",
    """SELECT c_custkey, CAST(rich AS INTEGER) AS rich, coalesce(CAST(rich AS INTEGER), -1) AS rich_filled
FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal > 5000 END AS rich FROM customer)""",
)
oracle("parse_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
oracle("narrow_types", "SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity FROM lineitem")
oracle(
    "pick_columns",
    """SELECT l_linestatus, max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice, max(l_discount) AS l_discount,
       max(l_tax) AS l_tax FROM lineitem GROUP BY 1""",
)
oracle("derive", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_tax * 2 AS l_tax, l_quantity + l_quantity AS double_qty FROM lineitem")
oracle("drop_columns", "SELECT * EXCLUDE (p_name, p_brand) FROM part")
oracle("rename_columns", "SELECT n_nationkey, n_name AS name, n_regionkey AS region FROM nation")
oracle("project_join_side", "SELECT o_custkey, o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
oracle("drop_all_null_rows", CASE_ORDERS, "SELECT o_orderkey, p, fday, until FROM co WHERE p IS NOT NULL OR fday IS NOT NULL OR until IS NOT NULL")
oracle("fill_null", CASE_ORDERS, "SELECT o_orderkey, coalesce(p, 0) AS p FROM co")
oracle("nan_to_null", "SELECT l_orderkey, l_partkey, l_suppkey, nullif(l_discount, 0) AS disc FROM lineitem")
oracle("sentinel_to_null", "SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer")
oracle("remap_values", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE -1 END AS status FROM orders")

# --- encoding ----------------------------------------------------------------------------------


def encoded(name: str, kind: str, expr: str, ending: str) -> None:
    ranked = f'rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY mean_target NULLS LAST, category) - 1 AS INTEGER) AS ordinal FROM lk)'
    oracle(
        name, LOOKUP, ranked,
        f"""SELECT doc_id, {expr.format(x=f'a.{kind}')} AS lang{ending}, {expr.format(x=f'b.{kind}')} AS source{ending}
FROM documents d LEFT JOIN rk a ON a."column" = 'lang' AND a.category = d.lang LEFT JOIN rk b ON b."column" = 'source' AND b.category = d.source""",
    )


oracle("fit_encodings", LOOKUP, f'SELECT "column", category, {f4("mean_target")} AS mean_target, frequency FROM lk')
encoded("encode_mean_target", "mean_target", f4("{x}"), "_mean_target")
encoded("encode_frequency", "frequency", "{x}", "_frequency")
encoded("encode_ordinal", "ordinal", "{x}", "_encoded")


def case_of(column: str, values: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


oracle("encode_hand_ranked", f"SELECT o_orderkey, {case_of('o_orderpriority', PRIORITY_RANKS)} AS rank FROM orders")
oracle("encode_to_number", f"SELECT o_orderkey, CAST({case_of('o_orderpriority', PRIORITY_DAYS)} AS DOUBLE) AS days FROM orders")
oracle(
    "encode_index", LABELLED, "ix AS (SELECT source, row_number() OVER (ORDER BY source) AS n FROM (SELECT DISTINCT source FROM lb WHERE source IS NOT NULL))",
    "SELECT doc_id, CAST(coalesce(n, 0) AS INTEGER) AS source_id FROM documents LEFT JOIN ix USING (source)",
)
oracle(
    "one_hot",
    """SELECT o_orderkey, CAST(w = '1-URGENT' AS INTEGER) AS priority_1, CAST(w = '2-HIGH' AS INTEGER) AS priority_2
FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS w FROM orders)""",
)
oracle("value_flag", "SELECT c_custkey, CAST(nullif(c_mktsegment, 'BUILDING') = 'MACHINERY' AS INTEGER) AS is_machinery FROM customer")
oracle("null_flag", CASE_ORDERS, "SELECT o_orderkey, CAST(p IS NULL AS INTEGER) AS p_null, CAST(until IS NULL AS INTEGER) AS until_null FROM co")
oracle(
    "mean_of_encodings", LOOKUP,
    f"""SELECT doc_id, {f4('(coalesce(a.mean_target, 0) + coalesce(b.mean_target, 0)) * 0.5::DOUBLE')} AS mixed
FROM documents d LEFT JOIN lk a ON a."column" = 'lang' AND a.category = d.lang LEFT JOIN lk b ON b."column" = 'source' AND b.category = d.source""",
)
oracle(
    "frequency_share", LOOKUP,
    f'SELECT "column", category, {f4("CAST(frequency AS DOUBLE) / sum(frequency) OVER (PARTITION BY " + chr(34) + "column" + chr(34) + ")")} AS share FROM lk',
)

# --- row functions -----------------------------------------------------------------------------

oracle("split_first", "SELECT o_orderkey, split_part(nullif(translate(o_orderpriority, '- ', '__'), '5_LOW'), '_', 1) AS first_part FROM orders")
oracle(
    "digits_to_int",
    """SELECT s_suppkey, TRY_CAST(regexp_replace(m, '[^0-9]', '') AS BIGINT) AS digits, TRY_CAST(regexp_replace(s_name, '[^0-9]', '') AS BIGINT) AS named
FROM (SELECT *, concat(s_suppkey % 50, 'x', s_nationkey, CASE WHEN s_nationkey % 4 = 0 THEN 'y' END) AS m FROM supplier)""",
)
oracle("days_between", CASE_ORDERS, "SELECT o_orderkey, CAST(until - day AS INTEGER) AS days, CAST(fday - DATE '1998-01-01' AS INTEGER) AS since FROM co")
oracle(
    "days_before_ref", CASE_ORDERS,
    "SELECT o_orderkey, " + ", ".join(f"CAST(DATE '1999-06-30' - {c} AS INTEGER) AS {c}" for c in ("day", "fday", "until")) + " FROM co",
)
oracle(
    "date_parts", CASE_ORDERS,
    """SELECT o_orderkey, CAST(isodow(day) AS INTEGER) AS day_weekday, CAST(month(day) AS INTEGER) AS day_month, CAST(quarter(day) AS INTEGER) AS day_quarter,
       CAST(week(day) AS INTEGER) AS day_week, CAST(year(day) AS INTEGER) AS day_year FROM co""",
)
oracle(
    "make_month_date", CASE_ORDERS,
    "SELECT o_orderkey, CASE WHEN m BETWEEN 1 AND 12 THEN make_date(year(day), CAST(m AS BIGINT), 1) END AS month_date FROM (SELECT *, month(day) + code - 2 AS m FROM co)",
)
oracle("latest_of_columns", CASE_ORDERS, "SELECT o_orderkey, greatest(fday, until) AS latest FROM co")
_bands = {"age_25": "y <= 25", "age_25_35": "y > 25 AND y <= 35", "age_35_45": "y > 35 AND y <= 45", "age_45_60": "y > 45 AND y <= 60", "age_60": "y > 60"}
oracle(
    "band_flags", CASE_ORDERS,
    "SELECT o_orderkey, " + ", ".join(f"CASE WHEN {cond} THEN 1 ELSE 0 END AS {n}" for n, cond in _bands.items())
    + " FROM (SELECT *, CAST(DATE '2020-01-01' - (fday - 9000) AS DOUBLE) * (1.0::DOUBLE / 365) AS y FROM co)",
)
oracle("scale", CASE_ORDERS, f"SELECT o_orderkey, p * 6 AS times6, {f4('code * (1.0::DOUBLE / 365)')} AS years FROM co")
oracle("in_list_flag", "SELECT o_orderkey, CAST(nullif(o_orderpriority, '5-LOW') IN ('1-URGENT', '3-MEDIUM') AS INTEGER) AS listed FROM orders")
oracle("safe_ratio", f"SELECT l_orderkey, l_partkey, l_suppkey, {f4('l_quantity / nullif(l_discount, 0)')} AS ratio FROM lineitem")

# --- joins -------------------------------------------------------------------------------------

oracle(
    "join_child_level", CASE_ORDERS, CASE_LINES, "r AS (SELECT l_orderkey, count(disc) AS n_disc, max(l_quantity) AS top_qty FROM cl GROUP BY 1)",
    "SELECT o_custkey AS case_id, o_orderkey AS num_group1, p, n_disc, top_qty FROM co LEFT JOIN r ON l_orderkey = o_orderkey",
)
oracle(
    "join_base", CASE_ORDERS, BASE, ROLLED,
    """SELECT case_id, "WEEK_NUM", target, n_p, top, 'inner' AS how FROM base JOIN rolled USING (case_id)
UNION ALL SELECT case_id, "WEEK_NUM", target, n_p, top, 'left' FROM base LEFT JOIN rolled USING (case_id)""",
)
oracle("join_target", CASE_ORDERS, BASE, ROLLED, 'SELECT case_id, n_p, top AS target, "WEEK_NUM", b.target AS target_right FROM rolled LEFT JOIN base b USING (case_id)')
oracle("join_weights", BASE, f"""SELECT *, {f4('"WEEK_NUM" / 7::DOUBLE')} AS weights FROM base""")
oracle(
    "cases_left", CASE_ORDERS, BASE, ROLLED,
    """SELECT 0 AS step, 'base' AS "table", count(*) AS cases FROM base
UNION ALL SELECT 1, 'orders', count(*) FROM base WHERE case_id IN (SELECT case_id FROM rolled)
UNION ALL SELECT 2, 'parts', count(*) FROM base WHERE case_id IN (SELECT case_id FROM rolled) AND case_id IN (SELECT l_partkey FROM lineitem)""",
)

# --- aggregations ------------------------------------------------------------------------------


def ratio(a: str, b: str) -> str:
    return f"({a}) / nullif({b}, 0)"


def total(x: str) -> str:
    return f"coalesce(sum({x}), 0)"


by_customer("agg_count_nonnull", num_p="count(p)", num_until="count(until)")
by_customer("agg_count_nonmissing", num_priority="count(nullif(o_orderpriority, '5-LOW'))")
by_customer(
    "agg_count_where", num_pos="count(*) FILTER (WHERE s > 0)", num_zero="count(*) FILTER (WHERE z = 0)",
    num_both="count(*) FILTER (WHERE until IS NOT NULL AND z > 0)",
)
by_customer("agg_basic", p_sum=f4(total("p")), p_mean=f4("avg(p)"), p_min="min(p)", p_max="max(p)")
_pos = "CASE WHEN s > 0 THEN s END"
by_customer(
    "agg_positive", s_max=f4(f"max({_pos})"), s_sum=f4(total(_pos)), s_mean=f4(f"avg({_pos})"), s_min=f4(f"min({_pos})"),
    s_std=f4(f"stddev_samp({_pos})"), s_median=f4(f"median({_pos})"),
)
oracle("agg_median", f"SELECT l_returnflag, l_linestatus, {f4('median(l_extendedprice)')} AS price_median FROM lineitem GROUP BY 1, 2")
by_customer(
    "agg_where", open_sum=f4("sum(coalesce(CASE WHEN until IS NOT NULL THEN p ELSE 0 END, 0))"),
    first_open="min(CASE WHEN until IS NOT NULL THEN day END)", last_open="max(CASE WHEN until IS NOT NULL THEN day END)",
)
by_customer("agg_first", p_first=f"{ordered('p')}[1]")
by_customer("agg_first_nonnull", p_first=f"({ordered('p', 'p IS NOT NULL')})[1]")
by_customer("agg_last", p_last=f"({ordered('p')})[-1]")
by_customer("agg_last_nonnull", p_last=f"({ordered('p', 'p IS NOT NULL')})[-1]", until_last=f"({ordered('until', 'until IS NOT NULL')})[-1]")
by_customer("agg_last_positive", s_last=f"({ordered('s', 's > 0')})[-1]")


def peak(c: str) -> str:
    listed = ordered(c, f"{c} > 0")
    return f"CAST(list_position({listed}, max(CASE WHEN {c} > 0 THEN {c} END)) - 1 AS BIGINT)"


by_customer("agg_argmax_pos", s_maxidx=peak("s"), z_maxidx=peak("z"))
_last_z = f"({ordered('z')})[-1]"
by_customer("agg_peak_drop", z_pos=f4(f"CASE WHEN max(z) = 0 AND {_last_z} = 0 THEN 1 ELSE {ratio(f'max(z) - {_last_z}', 'max(z)')} END"))
oracle(
    "agg_mode",
    """SELECT o_custkey, o_orderpriority AS priority_mode FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS r
    FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE r = 1""",
)
by_customer(
    "agg_span", p_span=f4("max(p) - min(p)"), until_days="CAST(max(until) - min(until) AS INTEGER)", years="CAST(year(max(day)) - year(min(day)) AS INTEGER)"
)
by_customer("agg_gap", gap=f4("min(o_totalprice) - max(s)"))
by_customer("agg_any_null", p_null="CAST(bool_or(p IS NULL) AS INTEGER)")
by_customer("agg_ratio_of", ratio_max=f4(ratio("max(s)", "max(z)")), ratio_sum=f4(ratio(total("s"), total("z"))), ratio_mean=f4(ratio("avg(s)", "avg(z)")))
by_customer("agg_of_ratio", ratio_max=f4(f"max({ratio('s', 'z')})"), ratio_mean=f4(f"avg({ratio('s', 'z')})"))
by_customer("agg_share", share=f4(ratio(total("z"), f"{total('z')} + {total('o_totalprice')}")))
by_customer("agg_diff_of", diff_max=f4("max(z) - max(s)"), diff_sum=f4(f"{total('z')} - {total('s')}"), diff_mean=f4("avg(z) - avg(s)"))
by_customer("agg_of_diff", diff_max=f4("max(z - s)"), gap_max=f4("max(abs(s - z))"))
by_customer(
    "agg_of_days", days_min="CAST(min(until - day) AS INTEGER)", days_max="CAST(max(until - day) AS INTEGER)", days_mean=f4("avg(until - day)"),
    days_std=f4("stddev_samp(until - day)"),
)
by_customer("agg_days_of", days="CAST(max(until) - max(fday) AS INTEGER)")
_norm = "avg(day - DATE '1994-12-01')"
by_customer("agg_days_norm", norm_mean=f4(ratio("avg(until - day)", _norm)), norm_std=f4(ratio("stddev_samp(until - day)", _norm)))
_days = "until - DATE '1970-01-01'"
by_customer("agg_date", until_max="max(until)", until_min="min(until)", until_mean=f"DATE '1970-01-01' + CAST(floor(avg({_days})) AS INTEGER)")
by_customer("agg_date_std", until_std=f"CAST(floor(stddev_samp({_days})) AS BIGINT)")
by_customer("agg_recent_flag", s_recent=f"CAST(min({_pos}) < 20000 AS INTEGER)")
by_customer("agg_rise_flag", p_rise=f"CASE WHEN ({ordered('p')})[-1] - ({ordered('p')})[1] > 0 THEN 1 ELSE 0 END")
by_customer("agg_first_last_ratio", z_ratio=f4(ratio(f"({ordered('z')})[1]", _last_z)))
by_customer("agg_onehot_sum", **{f"num_status_{v}": f"count(*) FILTER (WHERE o_orderstatus = '{v}')" for v in ("F", "O")})


def moded(c: str) -> str:
    return f"""(SELECT o_custkey, {c} AS m FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, {c}) AS r
    FROM (SELECT o_custkey, {c}, count(*) AS n FROM q WHERE {c} IS NOT NULL GROUP BY 1, 2)) WHERE r = 1)"""


oracle(
    "agg_encodings", CASE_ORDERS,
    "q AS (SELECT *, code AS c_enc, CAST(CASE WHEN o_orderstatus <> 'P' THEN month(day) END AS INTEGER) AS d_enc FROM co)",
    f"""g AS (SELECT o_custkey, {f4('avg(p)')} AS a_mean_target, {f4('avg(o_totalprice)')} AS b_mean_target, {f4('avg(code)')} AS e_frequency,
       ({ordered('c_enc', 'c_enc IS NOT NULL')})[-1] AS c_encoded_last, ({ordered('d_enc', 'd_enc IS NOT NULL')})[-1] AS d_encoded_last FROM q GROUP BY 1)""",
    f"SELECT g.*, c.m AS c_encoded_mode, d.m AS d_encoded_mode FROM g LEFT JOIN {moded('c_enc')} c USING (o_custkey) LEFT JOIN {moded('d_enc')} d USING (o_custkey)",
)
oracle(
    "agg_by_name_rule", CASE_LINES,
    "r AS (SELECT l_orderkey, count(disc) AS num_disc, min(l_quantity) AS qty_first, max(l_quantity) AS qty_last, max(ship) - min(ship) AS ship_duration FROM cl GROUP BY 1)",
    f"""SELECT o_custkey, CAST(coalesce(sum(num_disc), 0) AS BIGINT) AS num_disc, min(qty_first) AS qty_first_min, max(qty_last) AS qty_last_max,
       {f4('avg(ship_duration)')} AS ship_duration_mean, {f4('avg(qty_last - qty_first)')} AS qty_diff_mean
FROM orders LEFT JOIN r ON l_orderkey = o_orderkey GROUP BY 1""",
)

# --- sequences ---------------------------------------------------------------------------------

for _name, _kind in {
    "seq_tail_mean": "tail_mean", "seq_tail_max": "tail_max", "seq_diff_mean": "diffmean", "seq_diff_std": "diffstd", "seq_diff_last": "difflast",
}.items():
    oracle(_name, CASE_EVENTS, *sequence_sql("ce", ["user_id"], "ts, event_id", ["v", "value"], [_kind]))
ALL_KINDS = ["tail_mean", "tail_max", "diffmean", "diffstd", "difflast"]
KINDS = ["tail_mean", "diffmean", "diffstd", "difflast"]
oracle(
    "seq_lines", CASE_LINES,
    *sequence_sql("cl", ["l_orderkey"], "l_linenumber, l_partkey, l_suppkey, l_extendedprice", ["disc", "l_quantity", "l_extendedprice"], ALL_KINDS),
)

# --- hot groups --------------------------------------------------------------------------------

HOT_EVENTS = "he AS (SELECT * REPLACE (CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM ce)"
_seq, _seq_select = sequence_sql("he", ["user_id"], "ts, event_id", ["v"], ALL_KINDS)
oracle(
    "hot_sequence", CASE_EVENTS, HOT_EVENTS, _seq,
    f"""agg AS (SELECT user_id, count(*) AS n, {f4('median(v)')} AS v_median,
       CAST(list_position(list(v ORDER BY ts, event_id) FILTER (WHERE v > 0), max(CASE WHEN v > 0 THEN v END)) - 1 AS BIGINT) AS v_maxidx FROM he GROUP BY 1)""",
    f"SELECT * FROM agg JOIN ({_seq_select}) USING (user_id)",
)
oracle(
    "hot_row_numbers", CASE_EVENTS, HOT_EVENTS,
    """SELECT user_id, event_id, row_number() OVER (ORDER BY ts, event_id) AS place,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place_of_user FROM he""",
)

ORACLES["hot_mode"] = ORACLES["agg_mode"]


def tied(keys: str, order: str, source: str) -> str:
    return f"SELECT {keys}, CAST(count(*) AS BIGINT) AS tied_rows FROM (SELECT *, count(*) OVER (PARTITION BY {keys}, {order}) AS n FROM {source}) WHERE n > 1 GROUP BY {keys}"


oracle("order_ties", tied("l_suppkey", "l_shipdate", "lineitem"))
oracle(
    "order_report",
    f"""SELECT 'debitcard_1' AS "table", count(*) AS tied_keys, CAST(coalesce(sum(tied_rows), 0) AS BIGINT) AS tied_rows
FROM ({tied('o_custkey', 'o_orderkey % 4', 'orders')}) UNION ALL SELECT 'deposit_1', 0, 0""",
)

# --- whole jobs --------------------------------------------------------------------------------

_lines = f"""li AS (SELECT l_orderkey AS num_group1, {LINE_NUMBER} AS n2, nullif(l_discount, 0) AS "disc_1A", l_quantity AS "qty_2A",
    CAST(l_shipdate AS DATE) AS ship, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS flag FROM lineitem)"""
_seq, _seq_select = sequence_sql("li", ["num_group1"], "n2", ["disc_1A", "qty_2A"], KINDS)
oracle(
    "rollup_depth2", _lines, _seq,
    f"""agg AS (SELECT num_group1, count("disc_1A") AS "num_disc_1A", {f4(total('"disc_1A"'))} AS "disc_1A_sum", {f4('max("qty_2A")')} AS "qty_2A_max",
       CAST(max(ship) - min(ship) AS INTEGER) AS "ship_3D_duration", {f4('(list("qty_2A" ORDER BY n2))[-1]')} AS "qty_2A_last",
       CAST(list_position(list("qty_2A" ORDER BY n2), max("qty_2A")) - 1 AS BIGINT) AS "qty_2A_maxidx",
       CAST((list(flag ORDER BY n2) FILTER (WHERE flag IS NOT NULL))[-1] AS DOUBLE) AS "flag_4M_encoded_last" FROM li GROUP BY 1)""",
    """md AS (SELECT num_group1, CAST(flag AS DOUBLE) AS "flag_4M_encoded_mode" FROM (
    SELECT *, row_number() OVER (PARTITION BY num_group1 ORDER BY n DESC, flag) AS r
    FROM (SELECT num_group1, flag, count(*) AS n FROM li GROUP BY 1, 2)) WHERE r = 1)""",
    f"SELECT * FROM agg JOIN md USING (num_group1) JOIN ({_seq_select}) USING (num_group1)",
)
_seq, _seq_select = sequence_sql("j", ["case_id"], "num_group1", ["price_1A", "num_disc", "qty_last"], KINDS, ["num_disc"])
oracle(
    "rollup_depth1", CASE_ORDERS, CASE_LINES, "ch AS (SELECT l_orderkey, count(disc) AS num_disc, max(l_quantity) AS qty_last FROM cl GROUP BY 1)",
    'j AS (SELECT o_custkey AS case_id, o_orderkey AS num_group1, p AS "price_1A", day, num_disc, qty_last FROM co LEFT JOIN ch ON l_orderkey = o_orderkey)',
    _seq,
    f"""agg AS (SELECT case_id, count("price_1A") AS "num_price_1A", {f4('max("price_1A")')} AS "price_1A_max", {f4(total('"price_1A"'))} AS "price_1A_sum",
       {f4('median("price_1A")')} AS "price_1A_median", max(day) AS "day_2D_last", CAST(coalesce(sum(num_disc), 0) AS BIGINT) AS num_disc,
       {f4('max(qty_last)')} AS qty_last_max FROM j GROUP BY 1)""",
    f"SELECT * FROM agg JOIN ({_seq_select}) USING (case_id)",
)


def table_oracle(name: str, columns: Sequence[str], **aggs: str) -> None:
    """A depth-1 table: plain aggregates and the sequence features of its number columns."""
    seq, select = sequence_sql("t", ["case_id"], "num_group1", columns, KINDS)
    listed = ", ".join(f'{sql} AS "{n}"' for n, sql in aggs.items())
    oracle(f"table_{name}", f"t AS ({case_sql(name)})", seq, f"agg AS (SELECT case_id, {listed} FROM t GROUP BY 1)", f"SELECT * FROM agg JOIN ({select}) USING (case_id)")


def positives(c: str) -> str:
    return f"count(*) FILTER (WHERE {c} > 0)"


_bal, _t180, _t30 = "last180dayaveragebalance_704A", "last180dayturnover_1134A", "last30dayturnover_651A"
table_oracle(
    "debitcard_1", [_bal, _t180, _t30],
    **{f"num_{_bal}": positives(_bal)},
    **{f"{c}_sum": f4(total(c)) for c in (_bal, _t180, _t30)},
    **{f"{_bal}_{_t180}_ratio_{n}": f4(f"{k}({ratio(_bal, _t180)})") for n, k in (("max", "max"), ("mean", "avg"))},
    **{f"{_t30}_{_t180}_ratio_{n}": f4(f"{k}({ratio(f'6 * {_t30}', _t180)})") for n, k in (("max", "max"), ("mean", "avg"))},
    openingdate_857D_last="max(openingdate_857D)", openingdate_857D_first="min(openingdate_857D)",
)
_amt, _end, _open = "amount_416A", "contractenddate_991D", "openingdate_313D"
table_oracle(
    "deposit_1", [_amt], num_contractenddate_991D=f"count({_end})", num_amount_416A=positives(_amt),
    num_amount_416A_zero=f"count(*) FILTER (WHERE {_amt} = 0)",
    num_open_nonzero_deposits_416A=f"count(*) FILTER (WHERE {_end} IS NOT NULL AND {_amt} > 0)",
    amount_416A_sum=f4(total(_amt)), amount_416A_stillopen_sum=f4(f"coalesce(sum({_amt}) FILTER (WHERE {_end} IS NOT NULL), 0)"),
    openingdate_313D_first=f"min({_open}) FILTER (WHERE {_end} IS NOT NULL)", openingdate_313D_last=f"max({_open}) FILTER (WHERE {_end} IS NOT NULL)",
    contractenddate_991D_openingdate_313D_duration=f4(f"avg({_end} - {_open}) * (1.0::DOUBLE / 365)"),
)
_amt = "amount_4527230A"
_listed = f"list({_amt} ORDER BY num_group1)"
table_oracle(
    "tax_registry_a_1", [_amt], **{f"num_{_amt}": positives(_amt), f"{_amt}_sum": f4(total(_amt)), f"{_amt}_mean": f4(f"avg({_amt})")},
    amount_4527230A_first_last_ratio=f4(ratio(f"({_listed})[1]", f"({_listed})[-1]")), recorddate_4527225D="max(recorddate_4527225D)",
)
_amt, _day = "amount_4917619A", "deductiondate_4917603D"
table_oracle(
    "tax_registry_b_1", [_amt], **{f"num_{_amt}": positives(_amt), f"{_amt}_sum": f4(total(_amt)), f"{_amt}_mean": f4(f"avg({_amt})")},
    deductiondate_4917603D_last=f"max({_day})", deductiondate_4917603D_duration=f"CAST(max({_day}) - min({_day}) AS INTEGER)",
)
_amt, _day = "pmtamount_36A", "processingdate_168D"
table_oracle(
    "tax_registry_c_1", [_amt],
    **{f"num_{_amt}": positives(_amt), f"{_amt}_sum": f4(total(_amt)), f"{_amt}_mean": f4(f"avg({_amt})"), f"{_amt}_max": f4(f"max({_amt})")},
    processingdate_168D_last=f"max({_day})", processingdate_168D_duration=f"CAST(max({_day}) - min({_day}) AS INTEGER)",
)
_in, _out, _held = "amtdebitincoming_4809443A", "amtdebitoutgoing_4809440A", "amtdepositbalance_4809441A"
_din, _dout = "amtdepositincoming_4809444A", "amtdepositoutgoing_4809442A"
table_oracle(
    "other_1", [_in, _out, _held, _din, _dout], **{c: f4(total(c)) for c in (_in, _out, _held, _din, _dout)},
    **{f"{a}_{b}_ratio": f4(ratio(total(a), total(b))) for a, b in ((_in, _out), (_din, _dout), (_held, _in))},
)
_date, _due, _over = "pmts_date_1107D", "pmts_dpdvalue_108P", "pmts_pmtsoverdue_635A"
_seq, _seq_select = sequence_sql("t", ["case_id", "num_group1"], "num_group2", [_due, _over], KINDS)
_listed = {c: f"list({c} ORDER BY num_group2)" for c in (_due, _over)}
_aggs = {
    f"num_{_date}": f"count({_date})", f"num_{_due}": positives(_due),
    f"{_date}_first": f"CAST(year(min({_date})) AS INTEGER)", f"{_date}_last": f"CAST(year(max({_date})) AS INTEGER)",
    f"{_date}_duration": f"CAST(year(max({_date})) - year(min({_date})) AS INTEGER)", f"{_date}_duration_days": f"CAST(max({_date}) - min({_date}) AS INTEGER)",
    **{f"{c}_max": f4(f"max({c})") for c in _listed}, **{f"{c}_last": f4(f"({_listed[c]})[-1]") for c in _listed},
    **{f"{c}_pos": f4(f"CASE WHEN max({c}) = 0 AND ({_listed[c]})[-1] = 0 THEN 1 ELSE {ratio(f'max({c}) - ({_listed[c]})[-1]', f'max({c})')} END") for c in _listed},
    **{
        f"{c}_maxidx": f"CAST(list_position(list({c} ORDER BY num_group2) FILTER (WHERE {c} > 0), max(CASE WHEN {c} > 0 THEN {c} END)) - 1 AS BIGINT)"
        for c in _listed
    },
}
oracle(
    "table_credit_bureau_b_2", f"t AS ({case_sql('credit_bureau_b_2')})", _seq,
    "agg AS (SELECT case_id, num_group1, " + ", ".join(f'{sql} AS "{n}"' for n, sql in _aggs.items()) + " FROM t GROUP BY 1, 2)",
    f"SELECT * FROM agg JOIN ({_seq_select}) USING (case_id, num_group1)",
)
for _name in SPECS:
    ORACLES.setdefault(f"table_{_name}", spec_oracle(_name))
ORACLES["encode_table"] = encoded_oracle("credit_bureau_b_1")
ORACLES["assemble_features"] = job_oracle()
oracle("prune_features", "SELECT o_orderkey, CAST(o_orderkey % 5 AS INTEGER) AS c_encoded_last FROM orders")

# --- training ----------------------------------------------------------------------------------

_weeks = 'w AS (SELECT doc_id AS case_id, source AS "WEEK_NUM", quality AS target, lang, n_chars, toxic FROM lb)'
oracle(
    "class_weight_by_group", LABELLED, _weeks,
    f"""SELECT case_id, "WEEK_NUM", target, {f4('nullif(pos, 0)::DOUBLE / n')} AS weights
FROM (SELECT *, sum(target) OVER (PARTITION BY "WEEK_NUM") AS pos, count(*) OVER (PARTITION BY "WEEK_NUM", target) AS n FROM w)""",
)
oracle("split_roles", LABELLED, _weeks, "SELECT lang, n_chars, toxic, case_id FROM w")
oracle("stratified_group_folds", LABELLED, _weeks, "SELECT target, 1::BIGINT AS folds_per_group, CAST(count(*) AS BIGINT) AS rows_dealt, true AS even FROM w GROUP BY target")
oracle("train_boosted_trees", "SELECT fold, true AS many_trees, true AS as_good_as_best_column FROM (VALUES (0), (1)) AS t(fold)")
oracle("predict_score", "SELECT count(*) AS n, count(DISTINCT o_orderkey) AS cases, count(*) AS in_range FROM orders")
oracle("model_store", "SELECT count(*) AS same, count(*) AS n, 5 AS names FROM orders")
oracle("param_search", "SELECT place, true AS best_of_rest, true AS in_range FROM (VALUES (0), (1)) AS t(place)")
oracle("feature_importance", "SELECT 5::BIGINT AS features, true AS splits_add_up, true AS gains_add_up")
_scored = """sc AS (SELECT floor(o_totalprice / 1000) / 1000 AS score, CASE WHEN o_orderkey * 7 % 10 < 3 THEN 1 ELSE 0 END AS target,
    CAST(o_custkey % 5 AS DOUBLE) AS weight, CAST(o_custkey % 4 AS INTEGER) AS fold FROM orders)"""


def area(weight: str, key: str = "") -> str:
    part, group = (f"PARTITION BY {key}", f"GROUP BY {key}") if key else ("", "")
    shown = f"{key}, " if key else ""
    return f"""ar AS (SELECT {shown}sum(pos * (upto - neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM (
    SELECT *, sum(neg) OVER ({part} ORDER BY score) AS upto FROM (
        SELECT {shown}score, sum({weight} * target) AS pos, sum({weight} * (1 - target)) AS neg FROM sc GROUP BY {shown}score)) {group})"""


oracle("weighted_auc", _scored, area("weight"), f"SELECT {f4('auc')} AS auc FROM ar")
ORACLES["hot_auc"] = ORACLES["weighted_auc"]
oracle("auc", _scored, area("1.0::DOUBLE"), f"SELECT {f4('auc')} AS auc FROM ar")
oracle("cv_summary", _scored, area("1.0::DOUBLE", "fold"), f"SELECT CAST(count(*) AS INTEGER) AS folds, {f4('avg(auc)')} AS mean_score, {f4('max(auc)')} AS max_score FROM ar")
oracle("select_weak_features", "SELECT CAST(l_partkey AS VARCHAR) AS feature_name FROM lineitem GROUP BY l_partkey HAVING count(*) < 25")
