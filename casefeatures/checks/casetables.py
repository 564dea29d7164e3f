"""The sixteen detail tables in their real columns, derived from the test tables.

Cases are customers, depth-1 rows their orders, depth-2 rows the lines of the orders. Values come from whole-number
arithmetic on the row's keys, written in SQL that other engines read the same way.
"""

from __future__ import annotations

import re
from dataclasses import fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefeatures.functions.rows import MISSING
from casefeatures.plans.spec import TableSpec
from casefeatures.plans.tables import GIVEN, SPECS

COLUMN = re.compile(r"[a-z0-9]+(?:_[a-z0-9]+)*?_\d+[ADLMPT]")
BOOLEANS = (
    "contaddr_matchlist_1032L", "contaddr_smempladdr_334L", "remitter_829L", "safeguarantyflag_411L", "isbidproduct_390L",
    "isdebitcard_527L",
)
STATIC_NUMBERS = {
    "static_0": ("annuity_780A", "credamount_770A", "maxdpdlast12m_727P", "pmtnum_254L", "deferredmnthsnum_166L", "lastapprdate_640D", "firstdatedue_489D"),
    "static_cb_0": ("days30_165L", "numberofqueries_373L", "pmtssum_45A", "riskassesment_940T"),
}
BASE_SQL = """
    SELECT c_custkey AS case_id, CAST(c_nationkey AS BIGINT) AS WEEK_NUM, 201901 + c_nationkey AS MONTH,
           CASE WHEN c_acctbal > 6000 THEN 1 ELSE 0 END AS target,
           CAST(DATE '2001-01-01' + CAST(c_custkey % 400 AS INT) AS STRING) AS date_decision
    FROM customer"""


def line_number() -> Column:
    """A number that is unique among the lines of an order."""
    return F.expr(LINE_NUMBER)


LINE_NUMBER = "(CAST(l_linenumber AS BIGINT) * 1000000000000 + l_partkey * 100000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT)"

SOURCES = {
    0: ("c_custkey AS case_id", "c_custkey * 7919", "customer"),
    1: ("o_custkey AS case_id, o_orderkey AS num_group1", "o_orderkey * 7919", "orders"),
    2: (
        f"o_custkey AS case_id, o_orderkey AS num_group1, {LINE_NUMBER} AS num_group2",
        "o_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 31 + l_linenumber",
        "lineitem JOIN orders ON l_orderkey = o_orderkey",
    ),
}


def _words(value, found: dict) -> None:
    if isinstance(value, str):
        if COLUMN.fullmatch(value):
            found[value] = None
    elif isinstance(value, dict):
        for k, v in value.items():
            _words(k, found)
            _words(v, found)
    elif isinstance(value, (tuple, list)):
        for v in value:
            _words(v, found)
    elif hasattr(value, "column"):
        _words(value.column, found)


def raw_columns(spec: TableSpec) -> list[str]:
    """Column names a spec reads from its table."""
    found: dict[str, None] = {}
    for f in fields(spec):
        if f.name not in ("name", "child", "result", "counts_null", "drop", "result_drop"):
            _words(getattr(spec, f.name), found)
    for c in (*spec.counts_null, *STATIC_NUMBERS.get(spec.name, ())):
        found[c] = None
    made = {*spec.month_dates, *spec.latest, *spec.days, *spec.ages}
    below = set(raw_columns(SPECS[spec.child])) if spec.child else set()
    return [c for c in found if c not in made and c not in below and not c.startswith("num_") and not _double(c)]


def _double(c: str) -> bool:
    """Names made of two columns."""
    return len(re.findall(r"_\d+[ADLMPT](?=_|$)", c)) > 1


def _listed(spec: TableSpec, c: str) -> list[str]:
    out = list(spec.one_hot.get(c, {})) + [v for f, v in spec.flags.values() if f == c]
    for cat in spec.categories:
        if cat.column == c and cat.lookup in GIVEN:
            out += list(GIVEN[cat.lookup])
    return list(dict.fromkeys(out))


def kind_of(spec: TableSpec, c: str) -> str:
    """What a raw column holds: bool, date, year, month, place, word or num."""
    words = {k.column for k in spec.categories} | set(spec.one_hot) | {f for f, _ in spec.flags.values()} | set(spec.counts_of) | set(spec.bools)
    if c in BOOLEANS or c in spec.bools:
        return "bool"
    if c.endswith("D"):
        return "date"
    if c.endswith("T") and ("year_" in c or "month_" in c):
        return "year" if "year_" in c else "month"
    if c in spec.split_first:
        return "place"
    if c in words or c == "sex_738L" or c.endswith(("M", "T")) and c != "riskassesment_940T":
        return "word"
    return "num"


def _value(spec: TableSpec, c: str, i: int, seed: str) -> str:
    h = f"(({seed} + {i * 611953 + 17}) % 1000003)"
    kind, listed = kind_of(spec, c), _listed(spec, c)
    if kind == "bool":
        return f"CASE WHEN {h} % 9 = 0 THEN NULL ELSE {h} % 2 = 0 END"
    if c == "sex_738L":
        return f"CASE {h} % 5 WHEN 0 THEN NULL WHEN 1 THEN 'F' WHEN 2 THEN 'F' ELSE 'M' END"
    if kind == "date":
        return f"CASE WHEN {h} % 6 = 0 THEN NULL ELSE DATE '1996-01-01' + CAST({h} % 1700 AS INT) END"
    if kind == "year":
        return f"CASE WHEN {h} % 8 = 0 THEN NULL ELSE CAST(2008 + {h} % 12 AS STRING) || '.0' END"
    if kind == "month":
        return f"CASE WHEN {h} % 8 = 0 THEN NULL ELSE CAST(1 + {h} % 13 AS STRING) || '.0' END"
    if kind == "place":
        return f"CASE WHEN {h} % 7 = 0 THEN '{MISSING}' ELSE 'P' || CAST({h} % 40 AS STRING) || '_' || CAST({h} % 9 AS STRING) || '_x' END"
    if listed:
        cases = " ".join(f"WHEN {n} THEN '{v}'" for n, v in enumerate(listed))
        return f"CASE {h} % {len(listed) + 2} {cases} WHEN {len(listed)} THEN 'elsewhere' ELSE NULL END"
    if kind == "word":
        return f"CASE WHEN {h} % 5 = 0 THEN '{MISSING}' WHEN {h} % 17 = 0 THEN NULL ELSE 'k' || CAST({h} % 7 AS STRING) END"
    return f"CASE WHEN {h} % 11 = 0 THEN NULL WHEN {h} % 7 = 0 THEN 0e0 ELSE CAST({h} % 20000 AS DOUBLE) / 1e2 END"


def case_sql(name: str) -> str:
    """The SELECT that makes a detail table."""
    if name == "base":
        return BASE_SQL
    spec = SPECS[name]
    keys, seed, source = SOURCES[spec.depth]
    made = [f"{_value(spec, c, i, seed)} AS {c}" for i, c in enumerate(raw_columns(spec))]
    return f"SELECT {', '.join([keys, *made])} FROM {source}"


def case_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    for source in ("customer", "orders", "lineitem"):
        spark.read.parquet(f"{d}/{source}.parquet").createOrReplaceTempView(source)
    return spark.sql(case_sql(name))


def case_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {name: case_table(spark, d, name) for name in ("base", *SPECS)}
