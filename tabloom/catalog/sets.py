"""Whole feature plans over the subscription frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.catalog.base import S, query, rounded, subscriber_frame
from tabloom.operators.clean import normalise_target
from tabloom.plans import PLANS, FeatureTable, build_features
from tabloom.plans.subscription import (
    CATEGORIES,
    CROSSED_FLAGS,
    INTERNET,
    MONTHLY_EDGES,
    NUMBERS,
    SECURITY,
    SERVICES,
    STREAMING,
    TENURE_EDGES,
    TOTAL_EDGES,
)
from tabloom.session import materialise

RAW = ["id", "split", "fold", "y"]


def labelled_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = normalise_target(subscriber_frame(spark, sf_dir), "Churn", out="y").drop("Churn")
    # Every fitted step reads the frame, which is a join of three tables.
    return materialise(frame)


def planned(spark: SparkSession, sf_dir: str, name: str) -> FeatureTable:
    return build_features(PLANS[name], labelled_frame(spark, sf_dir))


def digits(name: str) -> int | None:
    """Decimals to compare at; None where both engines agree bit for bit."""
    if name.endswith(("_log", "_mean", "_std", "_diff")):
        return 6
    if name.endswith("_median"):
        return 8
    return 9 if name.endswith(("_te", "_woe", "_dist")) else None


def _filled(expression: str, name: str) -> str:
    if digits(name) is not None:
        expression = f"round({expression}, {digits(name)})"
    return f"coalesce({expression}, -999.0::DOUBLE) AS {name}"


def comparable(df: DataFrame) -> DataFrame:
    for places in (6, 8, 9):
        df = rounded(df, places, [c for c in df.columns if digits(c) == places])
    return df


def _is(col: str, value: str) -> str:
    return f"(CASE WHEN {col} = '{value}' THEN 1 ELSE 0 END)"


def _count(cols: Sequence[str], value: str) -> str:
    return "(" + " + ".join(_is(c, value) for c in cols) + ")"


_FLAG_SQL = {
    "fiber": _is("InternetService", "Fiber optic"),
    "dsl": _is("InternetService", "DSL"),
    "has_internet": "(CASE WHEN InternetService = 'No' THEN 0 ELSE 1 END)",
    "month_to_month": _is("Contract", "Month-to-month"),
    "one_year": _is("Contract", "One year"),
    "two_year": _is("Contract", "Two year"),
    "echeck": _is("PaymentMethod", "Electronic check"),
    "autopay": "(CASE WHEN PaymentMethod ILIKE '%automatic%' THEN 1 ELSE 0 END)",
}
_COUNT_SQL = {
    "n_services": _count(SERVICES, "Yes"),
    "n_active": _count(SERVICES, "Yes"),
    "n_internet": _count(INTERNET, "Yes"),
    "n_security": _count(SECURITY, "Yes"),
    "n_streaming": _count(STREAMING, "Yes"),
    "n_no_internet": _count(INTERNET, "No internet service"),
    "n_no": _count(SERVICES, "No"),
}
_NEW = "(CASE WHEN tenure < 12 THEN 1 ELSE 0 END)"
_UNSECURED = f"(CASE WHEN {_COUNT_SQL['n_security']} = 0 THEN 1 ELSE 0 END)"
_f = _FLAG_SQL
_DOUBLE_SQL = {
    "avg_spend": "TotalCharges / (tenure + 1)",
    "tenure_proxy": "TotalCharges / (MonthlyCharges + 0.01)",
    "tenure_proxy_by_one": "TotalCharges / (MonthlyCharges + 1)",
    "charge_ratio": "MonthlyCharges / (TotalCharges + 0.01)",
    "charge_tenure": "MonthlyCharges * tenure",
    "tenure_x_monthly": "tenure * MonthlyCharges",
    "charge_tenure_log": "ln(1 + MonthlyCharges * tenure)",
    "monthly_squared": "MonthlyCharges * MonthlyCharges",
    "tenure_log": "ln(1 + tenure)",
    "monthly_log": "ln(1 + MonthlyCharges)",
    "total_log": "ln(1 + TotalCharges)",
    "expected_total": "tenure * MonthlyCharges",
    "total_gap": "TotalCharges - tenure * MonthlyCharges",
    "total_gap_share": "(TotalCharges - tenure * MonthlyCharges) / (tenure * MonthlyCharges + 0.01)",
    "cost_per_service": f"MonthlyCharges / ({_COUNT_SQL['n_services']} + 1)",
    "cost_per_internet": f"MonthlyCharges / ({_COUNT_SQL['n_internet']} + 1)",
    **{f"{flag}_x_{n}": f"{_f[flag]} * {n}" for flag in CROSSED_FLAGS
       for n in ("MonthlyCharges", "TotalCharges")},
}
_LONG_SQL = {
    "tenure_squared": "tenure * tenure",
    "echeck_mtm": f"{_f['echeck']} * {_f['month_to_month']}",
    "fiber_mtm": f"{_f['fiber']} * {_f['month_to_month']}",
    "senior_mtm": f"SeniorCitizen * {_f['month_to_month']}",
    "senior_fiber": f"SeniorCitizen * {_f['fiber']}",
    "security_fiber": f"{_COUNT_SQL['n_security']} * {_f['fiber']}",
    "autopay_two_year": f"{_f['autopay']} * {_f['two_year']}",
    "senior_fiber_echeck": f"SeniorCitizen * {_f['fiber']} * {_f['echeck']}",
    **{f"{flag}_x_tenure": f"{_f[flag]} * tenure" for flag in CROSSED_FLAGS},
}
_INT_SQL = {
    **_FLAG_SQL,
    **_COUNT_SQL,
    "no_internet_mtm": f"(1 - {_f['has_internet']}) * {_f['month_to_month']}",
    "fiber_unsecured": f"{_f['fiber']} * {_UNSECURED}",
    "mtm_high_charge": f"{_f['month_to_month']} * (CASE WHEN MonthlyCharges > 70 THEN 1 ELSE 0 END)",
    "new_mtm": f"{_NEW} * {_f['month_to_month']}",
    "risk_score": f"{_NEW} + {_f['month_to_month']} + {_f['fiber']} + {_f['echeck']} + {_UNSECURED}",
}


def _bin_sql() -> dict[str, str]:
    found = {}
    for col, edge_sets in (
        ("tenure", TENURE_EDGES), ("MonthlyCharges", MONTHLY_EDGES), ("TotalCharges", TOTAL_EDGES)
    ):
        for name, edges in edge_sets.items():
            arms = " ".join(
                f"WHEN {col} > {low} AND {col} <= {high} THEN {i}.0::DOUBLE"
                for i, (low, high) in enumerate(zip(edges, edges[1:]))
            )
            found[name] = f"CASE {arms} END"
    return found


_BIN_SQL = _bin_sql()


def _row_sql(name: str) -> str:
    if name in _INT_SQL:
        return f"CAST({_INT_SQL[name]} AS INTEGER) AS {name}"
    if name in _LONG_SQL:
        return f"CAST({_LONG_SQL[name]} AS BIGINT) AS {name}"
    if name in _BIN_SQL:
        return f"coalesce({_BIN_SQL[name]}, -999.0::DOUBLE) AS {name}"
    return _filled(_DOUBLE_SQL[name], name)


def _stat_sql(plan) -> tuple[list[str], list[str], list[str]]:
    """Common table expressions, joins and columns of a plan's statistics."""
    tables, joins, columns = [], [], []
    train = "(SELECT * FROM s WHERE split = 'train')"
    for i, block in enumerate(plan.stats):
        keys = [f"coalesce({k}, 'nan') AS k{j}" for j, k in enumerate(block.keys)]
        values = ", ".join(
            f"avg({v}) AS mean_{v}, coalesce(stddev_samp({v}), 0) AS std_{v}, "
            f"median({v}) AS median_{v}"
            for v in block.values
        )
        tables.append(f"g{i} AS (SELECT {', '.join(keys)}, {values} FROM {train} GROUP BY ALL)")
        on = " AND ".join(f"coalesce(s.{k}, 'nan') = g{i}.k{j}" for j, k in enumerate(block.keys))
        joins.append(f"LEFT JOIN g{i} ON {on}")
        for v in block.values:
            default = "0"
            if block.unseen == "train_mean":
                default = f"(SELECT avg({v}) FROM {train})"
            prefix = block.prefix(v)
            mean = f"coalesce(g{i}.mean_{v}, {default})"
            parts = {
                "mean": mean,
                "std": f"coalesce(g{i}.std_{v}, 0)",
                "median": f"coalesce(g{i}.median_{v}, 0)",
            }
            columns += [_filled(parts[stat], f"{prefix}_{stat}") for stat in block.stats]
            if block.deviation:
                columns.append(_filled(f"s.{v} - {mean}", f"{prefix}_diff"))
    return tables, joins, columns


def plan_sql(name: str) -> str:
    """The table a plan gives, for plans of row features, statistics,
    frequencies, target encodings and codes."""
    plan = PLANS[name]
    tables, joins, columns = _stat_sql(plan)
    columns = [
        "s.id", "s.split", "s.fold",
        "CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y",
        *[f"s.{n}" if n in ("SeniorCitizen", "tenure") else _filled(f"s.{n}", n) for n in NUMBERS],
        *[_row_sql(f) for f in plan.row_features],
        *columns,
    ]
    for c in CATEGORIES:
        value = f"coalesce({c}, 'nan')"
        if plan.label_codes:
            tables.append(
                f"c_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
                f"FROM (SELECT DISTINCT {value} AS v FROM s))"
            )
            joins.append(f"JOIN c_{c} ON coalesce(s.{c}, 'nan') = c_{c}.v")
            columns.append(f"c_{c}.code AS {c}")
        else:
            columns.append(f"s.{c}")
        if plan.frequency:
            tables.append(
                f"f_{c} AS (SELECT {c} AS v, count(*) / sum(count(*)) OVER ()::DOUBLE AS share "
                f"FROM s WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c})"
            )
            joins.append(f"LEFT JOIN f_{c} ON s.{c} = f_{c}.v")
            columns.append(_filled(f"coalesce(f_{c}.share, 0)", f"{c}_freq"))
        if plan.target_encoding:
            tables += [
                f"o_{c} AS (SELECT {value} AS v, fold, "
                f"sum(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END) AS e, count(*) AS n "
                f"FROM s WHERE split = 'train' GROUP BY ALL)",
                f"a_{c} AS (SELECT v, sum(e) AS e, sum(n) AS n FROM o_{c} GROUP BY v)",
            ]
            joins += [
                f"LEFT JOIN a_{c} ON coalesce(s.{c}, 'nan') = a_{c}.v",
                f"LEFT JOIN o_{c} ON coalesce(s.{c}, 'nan') = o_{c}.v AND s.fold = o_{c}.fold",
            ]
            g = "(SELECT avg(CASE WHEN Churn = 'Yes' THEN 1.0 ELSE 0.0 END) FROM s WHERE split = 'train')"
            own = "CASE WHEN s.split = 'train' THEN coalesce(o_{c}.{x}, 0) ELSE 0 END"
            e = f"(a_{c}.e - {own.format(c=c, x='e')})"
            n = f"(a_{c}.n - {own.format(c=c, x='n')})"
            columns.append(_filled(f"coalesce(({e} + {g} * 10) / ({n} + 10), {g})", f"{c}_te"))
    ctes = (", " + ", ".join(tables)) if tables else ""
    return S + ctes + " SELECT " + ",\n  ".join(columns) + " FROM s " + "\n".join(joins)


def _plan_query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(planned(spark, sf_dir, name).df)

    return run


for _name, _plan in PLANS.items():
    if not (_plan.ranks or _plan.clusters or _plan.woe):
        query(f"features_{_name}", plan_sql(_name))(_plan_query(_name))


@query("features_evidence")
def features_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(planned(spark, sf_dir, "evidence").df)


_COUNTS = ", ".join(f"({n!r}, {c})" for n, c in (
    ("fast", 27), ("baseline", 26), ("quick", 31), ("ensemble", 56), ("set_a", 24), ("set_c", 47),
    ("solo", 45), ("stacked", 62),
))


@query(
    "feature_counts",
    f"SELECT p.name, p.n_features::INTEGER AS n_features, (SELECT count(*) FROM orders) AS n_rows "
    f"FROM (VALUES {_COUNTS}) p(name, n_features)",
)
def feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many feature columns and rows a plan gives."""
    names = ["fast", "baseline", "quick", "ensemble", "set_a", "set_c", "solo", "stacked"]
    parts = []
    # The plans share their input.
    frame = labelled_frame(spark, sf_dir)
    for name in names:
        built = build_features(PLANS[name], frame)
        parts.append(
            built.df.agg(
                F.lit(name).alias("name"),
                F.lit(len(built.features)).alias("n_features"),
                F.count(F.lit(1)).alias("n_rows"),
            )
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
