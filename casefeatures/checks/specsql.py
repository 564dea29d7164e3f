"""SQL for the detail tables: what a spec means, said once more for another engine.

All numbers of the result are doubles rounded by ``f4``; dates and words stay. Sequence features and modes are
computed on rows of (key, column name, value) and turned back into columns.
"""

from __future__ import annotations

from casefeatures.checks.casetables import case_sql, kind_of, raw_columns
from casefeatures.plans.spec import NO_SEQUENCE, TableSpec
from casefeatures.plans.tables import DROPPED_ENDINGS, GIVEN, INDEXED, JOIN_ORDER, ONE_VALUE_COLUMNS, PLACE_COLUMNS, SPECS

KEYS = {1: "case_id", 2: "case_id, num_group1"}
ORDER = {1: "num_group1", 2: "num_group2"}
STAT = {"sum": "coalesce(sum({x}), 0)", "mean": "avg({x})", "min": "min({x})", "max": "max({x})", "std": "stddev_samp({x})", "median": "median({x})"}


def f4(x: str) -> str:
    return f"floor(CAST({x} AS DOUBLE) * 10000 + 0.37::DOUBLE) / 10000"


def q(c: str) -> str:
    return f'"{c}"'


def num(c: str, spec: TableSpec | None = None) -> str:
    x = f"({q(c)} - DATE '1970-01-01')" if c.endswith("D") and not c.startswith("num_") else f"TRY_CAST({q(c)} AS DOUBLE)"
    return f"nullif({x}, {spec.null_values[c]})" if spec and c in spec.null_values else x


def stat(kind: str, x: str) -> str:
    return STAT[kind].format(x=x)


def ratio(a: str, b: str) -> str:
    return f"({a}) / nullif({b}, 0)"


def nth(x: str, o: str, place: int, cond: str = "TRUE") -> str:
    return f"(list({x} ORDER BY {o}) FILTER (WHERE {cond}))[{place}]"


def rows_sql(spec: TableSpec, lookups: str = "") -> tuple[list[str], dict[str, str]]:
    """Named subqueries up to ``e_name``, the encoded rows, and the kinds of its columns.

    Categories meet the lookups of this table, or those named ``k_lookups`` and ``v_lookups``.
    """
    n = spec.name
    kinds = {"case_id": "key"} | ({"num_group1": "key"} if spec.depth else {}) | ({"num_group2": "key"} if spec.depth == 2 else {})
    kinds |= {c: "word" if c.endswith(("M", "T")) else kind_of(spec, c) for c in raw_columns(spec)}
    made: dict[str, tuple[str, str]] = {}
    for name, (y, m) in spec.month_dates.items():
        yy, mm = (f"CAST(TRY_CAST({q(c)} AS DOUBLE) AS BIGINT)" for c in (y, m))
        made[name] = (f"CASE WHEN {mm} BETWEEN 1 AND 12 THEN make_date({yy}, {mm}, 1) END", "date")
    for c in spec.split_first:
        made[c] = (f"split_part(nullif({q(c)}, 'a55475b1'), '_', 1)", "word")
    for name, of in spec.latest.items():
        made[name] = (f"greatest({', '.join(map(q, of))})", "date")
    for name, (c, v) in spec.flags.items():
        made[name] = (f"CAST(CAST({q(c)} AS VARCHAR) = '{v}' AS INTEGER)", "num")
    for c, values in spec.one_hot.items():
        x = f"CAST({q(c)} AS VARCHAR)" if spec.one_hot_fill is None else f"coalesce({q(c)}, '{spec.one_hot_fill}')"
        made |= {f"{c}_{label}": (f"CAST({x} = '{v}' AS INTEGER)", "num") for v, label in values.items()}
    for c in spec.bools:
        made[c] = (f"CAST({q(c)} AS INTEGER)", "num")
    if "riskassesment_940T" in kinds:
        made["riskassesment_940T"] = ('CAST("riskassesment_940T" AS DOUBLE)', "num")
    kept = [q(c) for c in kinds if c not in made]
    ctes = [f"r_{n} AS ({case_sql(n)})", f"t_{n} AS (SELECT {', '.join([*kept, *[f'{x} AS {q(c)}' for c, (x, _) in made.items()]])} FROM r_{n})"]
    kinds |= {c: k for c, (_, k) in made.items()}

    def word(cat, source: str) -> str:
        x = f"CAST({source}{q(cat.column)} AS VARCHAR)"
        return x if cat.fill is None else f"coalesce({x}, '{cat.fill}')"

    fitted = {c.lookup: c for c in spec.categories if any(k != "value" for k, _ in c.kinds) and not c.fitted_on}
    if fitted:
        pairs = " UNION ALL ".join(f"SELECT '{col}' AS col, {word(c, 't.')} AS category, target FROM t_{n} t JOIN b_{n} USING (case_id)" for col, c in fitted.items())
        ctes += [
            f"b_{n} AS ({case_sql('base')})",
            f"""k_{n} AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY mean_target NULLS LAST, category) - 1 AS ordinal FROM (
    SELECT col, category, avg(target) AS mean_target, count(*) AS frequency FROM ({pairs}) WHERE category IS NOT NULL GROUP BY 1, 2))""",
        ]
    given = [f"('{col}', '{k}', {float(v)}::DOUBLE)" for col in sorted({c.lookup for c in spec.categories} & set(GIVEN)) for k, v in GIVEN[col].items()]
    values = [f"SELECT * FROM (VALUES {', '.join(given)}) v(col, category, value)"] if given else []
    values += [
        f"SELECT '{c}', {q(c)}, CAST(row_number() OVER (ORDER BY {q(c)}) AS DOUBLE) FROM (SELECT DISTINCT {q(c)} FROM t_{n} WHERE {q(c)} IS NOT NULL)"
        for c in INDEXED.get(n, ())
    ]
    if values:
        ctes.append(f"v_{n} AS ({' UNION ALL '.join(values)})")
    joins, shown, replaced = "", [], set()
    for i, cat in enumerate(spec.categories):
        source = "v" if cat.kinds[0][0] == "value" else "k"
        joins += f" LEFT JOIN {source}_{lookups or n} j{i} ON j{i}.col = '{cat.lookup}' AND j{i}.category = {word(cat, 't.')}"
        for kind, name in cat.kinds:
            x = f"j{i}.{kind}"
            shown.append(f"{x if cat.default is None else f'coalesce({x}, {cat.default})'} AS {q(name)}")
            replaced.add(name)
            kinds[name] = "num"
    kept = [f"t.{q(c)}" for c in kinds if c not in replaced]
    ctes.append(f"c_{n} AS (SELECT {', '.join([*kept, *shown])} FROM t_{n} t{joins})")
    later = [f"(coalesce({q(a)}, 0) + coalesce({q(b)}, 0)) * 0.5::DOUBLE AS {q(c)}" for c, (a, b) in spec.mixed.items()]
    later += [f"{q(a)} - {q(b)} AS {q(c)}" for c, (a, b) in spec.days.items()]
    kinds |= {c: "num" for c in (*spec.mixed, *spec.days)}
    for name, (a, b, bounds) in spec.ages.items():
        y = f"(CAST({q(a)} - {q(b)} AS DOUBLE) * (1.0::DOUBLE / 365))"
        conds = [(f"{bounds[0]}", f"{y} <= {bounds[0]}")]
        conds += [(f"{lo}_{hi}", f"{y} > {lo} AND {y} <= {hi}") for lo, hi in zip(bounds, bounds[1:])]
        conds += [(f"{bounds[-1]}", f"{y} > {bounds[-1]}")]
        later += [f"CASE WHEN {cond} THEN 1 ELSE 0 END AS {q(f'{name}_{label}')}" for label, cond in conds]
        kinds |= {f"{name}_{label}": "num" for label, _ in conds}
    kinds = {c: k for c, k in kinds.items() if c not in spec.drop}
    made_later = {x.rsplit(" AS ", 1)[1].strip('"') for x in later}
    ctes.append(f"e_{n} AS (SELECT {', '.join([*[q(c) for c in kinds if c not in made_later], *later])} FROM c_{n})")
    return ctes, kinds


def aggs_sql(spec: TableSpec, kinds: dict[str, str]) -> dict[str, tuple[str, str]]:
    """Per result column its SQL and its kind, sequences, modes, peaks and medians aside."""
    o, out = ORDER[spec.depth], {}

    def number(name: str, sql: str) -> None:
        out[name] = (sql, "num")

    def n(c: str) -> str:
        return num(c, spec)

    for c in spec.counts:
        number(f"num_{c}", f"count({q(c)})")
    for c in spec.counts_known:
        number(f"num_{c}", f"count(nullif({q(c)}, 'a55475b1'))")
    for c in spec.counts_positive:
        number(f"num_{c}", f"count(*) FILTER (WHERE {n(c)} > 0)")
    for c in spec.counts_zero:
        number(f"num_{c}_zero", f"count(*) FILTER (WHERE {n(c)} = 0)")
    for name, (a, b) in spec.counts_both.items():
        number(name, f"count(*) FILTER (WHERE {q(a)} IS NOT NULL AND {n(b)} > 0)")
    for name, (kind, c, known) in spec.where.items():
        if kind == "sum":
            number(name, f"coalesce(sum(CASE WHEN {q(known)} IS NOT NULL THEN {n(c)} ELSE 0 END), 0)")
        else:
            out[name] = (f"{kind}({q(c)}) FILTER (WHERE {q(known)} IS NOT NULL)", "date" if kinds[c] == "date" else "num")
    for name, (c, bound) in spec.counts_above.items():
        number(name, f"count(*) FILTER (WHERE {n(c)} > {bound})")
    for c, names in spec.counts_of.items():
        for v, name in names.items():
            # whole numbers held as doubles are written with .0
            number(name, f"count(*) FILTER (WHERE CAST({q(c)} AS VARCHAR) = '{v}')")
    for c, name in spec.counts_null.items():
        number(name, f"count(*) FILTER (WHERE {q(c)} IS NULL)")
    for kind, columns in spec.positive.items():
        for c in columns:
            number(f"{c}_{kind}", stat(kind, f"CASE WHEN {n(c)} > 0 THEN {n(c)} END"))
    for c in spec.medians:
        number(f"{c}_median", stat("median", f"CASE WHEN {n(c)} > 0 THEN {n(c)} END"))
    for name, (kind, c) in spec.stats.items():
        number(name, stat(kind, n(c)))
    for c in spec.any_null:
        number(f"{c}_null", f"CAST(bool_or({q(c)} IS NULL) AS INTEGER)")
    for name, (kind, a, b) in spec.ratios.items():
        number(name, ratio(stat(kind, n(a)), stat(kind, n(b))))
    for name, (kind, a, b) in spec.row_ratios.items():
        number(name, stat(kind, ratio(n(a), n(b))))
    for name, (kind, a, b) in spec.row_ratios_zero.items():
        number(name, stat(kind, f"CASE WHEN {n(a)} IS NULL OR {n(b)} IS NULL THEN 0 ELSE {ratio(n(a), n(b))} END"))
    for name, (a, b) in spec.shares.items():
        number(name, ratio(stat("sum", n(a)), f"{stat('sum', n(a))} + {stat('sum', n(b))}"))
    for name, (kind, a, b) in spec.diffs.items():
        number(name, f"{stat(kind, n(a))} - {stat(kind, n(b))}")
    for name, (kind, a, b) in spec.row_diffs.items():
        number(name, stat(kind, f"{n(a)} - {n(b)}"))
    for name, (kind, a, b) in spec.row_gaps.items():
        number(name, stat(kind, f"abs({n(a)} - {n(b)})"))
    for name, (c, below) in spec.recent.items():
        number(name, f"CAST(min(CASE WHEN {n(c)} > 0 THEN {n(c)} END) < {below} AS INTEGER)")
    for name, (kind, a, b) in spec.row_days.items():
        number(name, stat(kind, f"({q(a)} - {q(b)})"))
    for name, (a, b) in spec.group_days.items():
        number(name, f"max({q(a)}) - max({q(b)})")
    for name, (kind, a, b, c, d) in spec.days_norm.items():
        number(name, ratio(stat(kind, f"({q(a)} - {q(b)})"), stat("mean", f"({q(c)} - {q(d)})")))
    for name, (kind, c) in spec.dates.items():
        mean = f"DATE '1970-01-01' + CAST(floor(avg({q(c)} - DATE '1970-01-01')) AS INTEGER)"
        out[name] = (mean if kind == "mean" else f"{kind}({q(c)})", "date")
    for name, (part, kind, c) in spec.date_numbers.items():
        number(name, f"{part}({kind}({q(c)}))")
    for name, c in spec.spans.items():
        number(name, f"max({n(c)}) - min({n(c)})")
    for name, c in spec.span_days.items():
        number(name, f"max({q(c)}) - min({q(c)})")
    for name, c in spec.span_years.items():
        number(name, f"year(max({q(c)})) - year(min({q(c)}))")
    for name, (a, b) in spec.gaps.items():
        number(name, f"min({n(a)}) - max({n(b)})")
    for name, (a, b) in spec.wide_spans.items():
        number(name, f"max({q(a)}) - min({q(b)})")
    for name, c in spec.date_std.items():
        number(name, f"floor(stddev_samp({q(c)} - DATE '1970-01-01'))")
    for c in spec.first:
        out[c] = (nth(q(c), o, 1), kinds.get(c, "num"))
    for c in spec.first_nonnull:
        out[c] = (nth(q(c), o, 1, f"{q(c)} IS NOT NULL"), kinds.get(c, "num"))
    for name, c in spec.last.items():
        number(name, nth(q(c), o, -1))
    for name, c in spec.last_nonnull.items():
        out[name] = (nth(q(c), o, -1, f"{q(c)} IS NOT NULL"), kinds.get(c, "num"))
    for name, c in spec.last_positive.items():
        number(name, nth(n(c), o, -1, f"{n(c)} > 0"))
    for c in spec.peaks:
        number(f"{c}_maxidx", f"list_position(list({n(c)} ORDER BY {o}) FILTER (WHERE {n(c)} > 0), max(CASE WHEN {n(c)} > 0 THEN {n(c)} END)) - 1")
    for c in spec.peak_drops:
        last = nth(q(c), o, -1)
        number(f"{c}_pos", f"CASE WHEN max({q(c)}) = 0 AND {last} = 0 THEN 1 ELSE {ratio(f'max({q(c)}) - {last}', f'max({q(c)})')} END")
    for name, c in spec.rises.items():
        number(name, f"CASE WHEN {nth(n(c), o, -1)} - {nth(n(c), o, 1)} > 0 THEN 1 ELSE 0 END")
    for name, c in spec.first_last.items():
        number(name, ratio(nth(n(c), o, 1), nth(n(c), o, -1)))
    for name, by in spec.scaled.items():
        number(name, f"({out[name][0]}) * {by}::DOUBLE")
    for c in kinds:
        if spec.average_endings and c.endswith(spec.average_endings):
            number(c, f"avg({q(c)})")
        if spec.order_endings and c.endswith(spec.order_endings):
            number(f"{c}_last", nth(q(c), o, -1, f"{q(c)} IS NOT NULL"))
        if not spec.name_rules:
            continue
        if c.startswith("num_") and kinds[c] != "key":
            number(c, f"coalesce(sum({q(c)}), 0)")
        for endings, how, ending in ((("_mean", "_duration", "_diff"), "avg", "mean"), (("_first",), "min", "min"), (("_last",), "max", "max")):
            if c.endswith(endings):
                number(f"{c}_{ending}", f"{how}({q(c)})")
    return out


def table_sql(spec: TableSpec, lookups: str = "") -> tuple[list[str], dict[str, str]]:
    """Named subqueries up to ``g_name``, the rolled-up table before rounding, and the kinds of its columns."""
    n = spec.name
    ctes, kinds = rows_sql(spec, lookups)
    if spec.depth == 0:
        return [*ctes, f"g_{n} AS (SELECT * FROM e_{n})"], kinds
    source = f"e_{n}"
    if spec.child:
        below, child = table_sql(SPECS[spec.child], lookups)
        ctes = below + ctes + [f"x_{n} AS (SELECT * FROM e_{n} LEFT JOIN g_{spec.child} USING (case_id, num_group1))"]
        kinds |= {c: k for c, k in child.items() if k != "key"}
        source = f"x_{n}"
    key, o = KEYS[spec.depth], ORDER[spec.depth]
    aggs = aggs_sql(spec, kinds)
    ctes.append(f"a_{n} AS (SELECT {key}, {', '.join(f'{x} AS {q(c)}' for c, (x, _) in aggs.items())} FROM {source} GROUP BY {key})")
    out, joined = {k: "key" for k in key.split(", ")} | {c: k for c, (_, k) in aggs.items()}, f"a_{n}"
    moded = [c for c in kinds if spec.order_endings and c.endswith(spec.order_endings)]
    seq = [c for c, k in kinds.items() if k == "num" and not c.endswith(NO_SEQUENCE[spec.depth])] if spec.sequences else []
    for what, columns in (("m", moded), ("s", seq)):
        if not columns:
            continue
        cast = ", ".join(f"CAST({q(c)} AS DOUBLE) AS {q(c)}" for c in columns)
        ctes.append(
            f"{what}l_{n} AS (SELECT * FROM (UNPIVOT (SELECT {key}, {o}_ AS o_, * EXCLUDE ({key}, {o}_) FROM (SELECT {key}, {o} AS {o}_, {cast} FROM {source})) "
            f"ON * EXCLUDE ({key}, o_) INTO NAME col VALUE x))"
        )
        if what == "m":
            ctes.append(
                f"""mw_{n} AS (SELECT {key}, {', '.join(f"max(x) FILTER (WHERE col = '{c}') AS {q(c + '_mode')}" for c in columns)} FROM (
    SELECT *, row_number() OVER (PARTITION BY {key}, col ORDER BY n DESC, x) AS r FROM (SELECT {key}, col, x, count(*) AS n FROM ml_{n} GROUP BY ALL))
    WHERE r = 1 GROUP BY {key})"""
            )
            out |= {f"{c}_mode": "num" for c in columns}
        else:
            shown = ", ".join(f"max({k}) FILTER (WHERE col = '{c}') AS {q(f'{c}_{k}')}" for c in columns for k in spec.sequence_kinds)
            ctes.append(
                f"""sw_{n} AS (SELECT {key}, {shown} FROM (
    SELECT {key}, col, avg(x) FILTER (WHERE r <= 3) AS tail_mean, max(x) FILTER (WHERE r <= 3) AS tail_max, avg(step) AS diffmean,
           stddev_samp(step) AS diffstd, max(step) FILTER (WHERE r = 1) AS difflast
    FROM (SELECT *, row_number() OVER (PARTITION BY {key}, col ORDER BY o_ DESC) AS r, x - lag(x) OVER (PARTITION BY {key}, col ORDER BY o_) AS step FROM sl_{n})
    GROUP BY {key}, col) GROUP BY {key})"""
            )
            out |= {f"{c}_{k}": "num" for c in columns for k in spec.sequence_kinds}
        joined += f" LEFT JOIN {what}w_{n} USING ({key})"
    ctes.append(f"g_{n} AS (SELECT * FROM {joined})")
    return ctes, out


def person_result(kinds: dict[str, str]) -> tuple[dict[str, str], dict[str, str]]:
    """The columns of person_1 that are made from first values, and the kinds of the result."""
    unstable = "'CHARITY_RELIGIOUS', 'GAMING', 'RECRUITMENT', 'WELNESS', 'TOURISM', 'AGRICULTURE', 'TRADE', 'REAL_ESTATE'"
    made = {
        "empl_industry_691L_unstable": f"CAST(empl_industry_691L IN ({unstable}) AS INTEGER)",
        "sex_738L": "CASE sex_738L WHEN 'F' THEN 0 WHEN 'M' THEN 1 ELSE -1 END",
        **{c: f"TRY_CAST(regexp_replace({c}, '[^0-9]', '') AS BIGINT)" for c in ("contaddr_district_15M", "contaddr_zipcode_807M", "empladdr_zipcode_114M")},
        **{c: f"CAST({c} AS INTEGER)" for c in ("contaddr_matchlist_1032L", "contaddr_smempladdr_334L")},
        **{c: f"coalesce(CAST({c} AS INTEGER), -1)" for c in ("remitter_829L", "safeguarantyflag_411L")},
        "childnum_185L": "TRY_CAST(trunc(childnum_185L) AS SMALLINT)",
        "empl_employedfrom_271D_isemployed": "CAST(empl_employedfrom_271D IS NOT NULL AS INTEGER)",
        "empls_employedfrom_796D_271D": "greatest(empls_employedfrom_796D, empl_employedfrom_271D)",
        "birth_259D_87D": "greatest(birth_259D, birthdate_87D)",
    }
    out = {c: k for c, k in kinds.items() if c not in SPECS["person_1"].result_drop}
    out |= {c: "date" if c.endswith("D") else "num" for c in made} | {"empl_employedfrom_271D_isemployed": "num"}
    return made, out


def spec_oracle(name: str) -> str:
    spec = SPECS[name]
    ctes, kinds = table_sql(spec)
    made: dict[str, str] = {}
    if name == "person_1":
        made, kinds = person_result(kinds)
    shown = []
    for c, k in kinds.items():
        x = made.get(c, q(c))
        shown.append(f"{f4(x) if k in ('num', 'bool') else x} AS {q(c)}")
    return f"WITH {', '.join(ctes)} SELECT {', '.join(shown)} FROM g_{name}"


def encoded_oracle(name: str) -> str:
    """The encoded rows of a table, before any grouping."""
    ctes, kinds = rows_sql(SPECS[name])
    shown = [f"{f4(q(c)) if k in ('num', 'bool') else q(c)} AS {q(c)}" for c, k in kinds.items()]
    return f"WITH {', '.join(ctes)} SELECT {', '.join(shown)} FROM e_{name}"


def job_oracle() -> str:
    """The whole job on training data: lookups of all tables together, every roll-up joined to the base, dates as days before the decision.

    Numbers are cut to four decimals and then held as narrowly as the job holds them (4 bytes).
    """
    ctes, wide = [], {}
    shown, joins = [], ""
    for name in JOIN_ORDER:
        made: dict[str, str] = {}
        more, kinds = table_sql(SPECS[name], "all")
        if name == "person_1":
            made, kinds = person_result(kinds)
        ctes += more
        # What follows from a roll-up's columns is read from that table alone.
        ctes.append(f"w_{name} AS (SELECT {', '.join(f'{made.get(c, q(c))} AS {q(c)}' for c in kinds)} FROM g_{name})")
        joins += f" JOIN w_{name} USING (case_id)"
        for c, k in kinds.items():
            if c == "case_id":
                continue
            free = c if c not in wide else f"{c}_right"
            wide[free] = k
            shown.append((free, f"w_{name}.{q(c)}"))
    # Lookups are fitted on the rows as they come, so they go before whatever is encoded with them.
    fitting = [x for x in ctes if x.split("_", 1)[0] in ("r", "t", "b", "k", "v")]
    lookups = [
        f"{kind}_all AS ({' UNION '.join(f'SELECT * FROM {x.split(maxsplit=1)[0]}' for x in fitting if x.startswith(f'{kind}_'))})" for kind in ("k", "v")
    ]
    rest = [x for x in ctes if x not in fitting]
    out = ["b.case_id", f'{f4("b.WEEK_NUM")} AS "WEEK_NUM"', f'{f4("b.MONTH")} AS "MONTH"', f'{f4("b.target")} AS target']
    ref = "CAST(b.date_decision AS DATE)"
    narrow = "CAST(CAST({x} AS FLOAT) AS DOUBLE)"
    out += [f"{narrow.format(x=f4(f'{part}({ref})'))} AS date_decision_{name}" for part, name in (("isodow", "weekday"), ("month", "month"), ("quarter", "quarter"), ("week", "week"))]
    gone = {*PLACE_COLUMNS, *ONE_VALUE_COLUMNS}
    for c, x in shown:
        if c in gone or c.endswith(DROPPED_ENDINGS):
            continue
        k = wide[c]
        if k == "date":
            out.append(f"{narrow.format(x=f4(f'{ref} - {x}'))} AS {q(c)}")
        else:
            out.append(f"{narrow.format(x=f4(x)) if k in ('num', 'bool') else x} AS {q(c)}")
    return f"WITH {', '.join([*fitting, *lookups, *rest])} SELECT {', '.join(out)} FROM ({case_sql('base')}) b{joins}"
