"""Feature plans for a table of subscribers.

Each formula has one name here, shared by all plans that use it. Column names
and category values are those of the subscription table; edges, offsets and
bounds are part of the features' definition.
"""

from __future__ import annotations

from tabloom.operators import features as fx
from tabloom.operators.groupstats import StatBlock, stat_blocks
from tabloom.operators.ranks import RankSpec
from tabloom.plans.plan import ClusterPlan, FeaturePlan

# Columns of the subscription table.
SECURITY = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport"]
STREAMING = ["StreamingTV", "StreamingMovies"]
INTERNET = [*SECURITY, *STREAMING]
SERVICES = ["PhoneService", "MultipleLines", "InternetService", *INTERNET]
CATEGORIES = [
    "gender",
    "Partner",
    "Dependents",
    *SERVICES,
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
]
NUMBERS = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]
TENURE, MONTHLY, TOTAL = "tenure", "MonthlyCharges", "TotalCharges"

# Bin edges.
TENURE_EDGES = {
    "tenure_bin_from_zero": [0, 12, 24, 48, 72, 999],
    "tenure_bin_six": [-1, 6, 12, 24, 48, 72, 999],
    "tenure_bin_seven": [-1, 3, 6, 12, 24, 48, 72, 999],
}
MONTHLY_EDGES = {
    "monthly_bin_from_zero": [0, 30, 50, 70, 90, 999],
    "monthly_bin_six": [-1, 20, 40, 60, 80, 100, 999],
    "monthly_bin_seven": [-1, 20, 35, 50, 65, 80, 95, 999],
}
TOTAL_EDGES = {"total_bin": [-1, 500, 1000, 2000, 4000, 6000, 999999]}

# The flags that are crossed with numbers.
CROSSED_FLAGS = ["month_to_month", "fiber", "echeck", "autopay", "dsl", "has_internet"]


def _row_features() -> dict[str, fx.Feature]:
    amounts = [
        fx.ratio("avg_spend", TOTAL, TENURE, 1),
        fx.ratio("tenure_proxy", TOTAL, MONTHLY, 0.01),
        fx.ratio("tenure_proxy_by_one", TOTAL, MONTHLY, 1),
        fx.ratio("charge_ratio", MONTHLY, TOTAL, 0.01),
        fx.product("charge_tenure", MONTHLY, TENURE),
        fx.product("tenure_x_monthly", TENURE, MONTHLY),
        fx.log1p("charge_tenure_log", MONTHLY, TENURE),
        fx.power("tenure_squared", TENURE),
        fx.power("monthly_squared", MONTHLY),
        fx.log1p("tenure_log", TENURE),
        fx.log1p("monthly_log", MONTHLY),
        fx.log1p("total_log", TOTAL),
        fx.product("expected_total", TENURE, MONTHLY),
        fx.difference("total_gap", TOTAL, "expected_total"),
        fx.relative_difference("total_gap_share", TOTAL, "expected_total", 0.01),
    ]
    counts = [
        fx.count_equal("n_services", SERVICES, "Yes"),
        fx.count_active("n_active", SERVICES, "Yes"),
        fx.count_equal("n_internet", INTERNET, "Yes"),
        fx.count_equal("n_security", SECURITY, "Yes"),
        fx.count_equal("n_streaming", STREAMING, "Yes"),
        fx.count_equal("n_no_internet", INTERNET, "No internet service"),
        fx.count_equal("n_no", SERVICES, "No"),
        fx.ratio("cost_per_service", MONTHLY, "n_services", 1),
        fx.ratio("cost_per_internet", MONTHLY, "n_internet", 1),
    ]
    flags = [
        fx.flag_equal("fiber", "InternetService", "Fiber optic"),
        fx.flag_equal("dsl", "InternetService", "DSL"),
        fx.flag_not_equal("has_internet", "InternetService", "No"),
        fx.flag_equal("month_to_month", "Contract", "Month-to-month"),
        fx.flag_equal("one_year", "Contract", "One year"),
        fx.flag_equal("two_year", "Contract", "Two year"),
        fx.flag_equal("echeck", "PaymentMethod", "Electronic check"),
        fx.flag_contains("autopay", "PaymentMethod", "automatic"),
    ]
    crosses = fx.cross(CROSSED_FLAGS, [TENURE, MONTHLY, TOTAL])
    combined = [
        fx.product("echeck_mtm", "echeck", "month_to_month"),
        fx.product("fiber_mtm", "fiber", "month_to_month"),
        fx.product("senior_mtm", "SeniorCitizen", "month_to_month"),
        fx.product("senior_fiber", "SeniorCitizen", "fiber"),
        fx.product("security_fiber", "n_security", "fiber"),
        fx.product("autopay_two_year", "autopay", "two_year"),
        fx.rule_flag("no_internet_mtm", fx.is_zero("has_internet"), fx.is_set("month_to_month")),
        fx.rule_flag("fiber_unsecured", fx.is_set("fiber"), fx.is_zero("n_security")),
        fx.rule_flag("mtm_high_charge", fx.is_set("month_to_month"), fx.over(MONTHLY, 70)),
        fx.rule_flag("new_mtm", fx.under(TENURE, 12), fx.is_set("month_to_month")),
        fx.product("senior_fiber_echeck", "SeniorCitizen", "fiber", "echeck"),
        fx.additive_score(
            "risk_score",
            fx.under(TENURE, 12),
            fx.is_set("month_to_month"),
            fx.is_set("fiber"),
            fx.is_set("echeck"),
            fx.is_zero("n_security"),
        ),
    ]
    bins = [
        *[fx.cut(name, TENURE, edges) for name, edges in TENURE_EDGES.items()],
        *[fx.cut(name, MONTHLY, edges) for name, edges in MONTHLY_EDGES.items()],
        *[fx.cut(name, TOTAL, edges) for name, edges in TOTAL_EDGES.items()],
    ]
    listed = [*amounts, *counts, *flags, *crosses, *combined, *bins]
    return {feature.name: feature for feature in listed}


ROW_FEATURES = _row_features()


def _crossed(flags: list[str], numbers: list[str]) -> tuple[str, ...]:
    return tuple(f"{flag}_x_{number}" for flag in flags for number in numbers)


# The categories and pairs of them that statistics are taken by.
_MAIN_KEYS = ["Contract", "InternetService", "PaymentMethod"]
_KEY_PAIRS = [
    ("Contract", "InternetService"),
    ("Contract", "PaymentMethod"),
    ("InternetService", "PaymentMethod"),
]
_MEANS = ("mean",)

# Mean, deviation of and distance from three numbers per category, and two
# numbers per pair of categories.
FULL_STATS = (
    *stat_blocks(_MAIN_KEYS, [MONTHLY, TOTAL, TENURE]),
    *stat_blocks(_KEY_PAIRS, [MONTHLY, TENURE], stats=_MEANS),
)
LITE_STATS = tuple(stat_blocks(_MAIN_KEYS, [MONTHLY, TENURE], stats=_MEANS))
MEAN_STATS = tuple(stat_blocks(_MAIN_KEYS, [MONTHLY, TOTAL, TENURE], stats=_MEANS))
HEAVY_STATS = (
    *stat_blocks(
        [*_MAIN_KEYS, "gender", "Partner", "Dependents", "PaperlessBilling"],
        [MONTHLY, TOTAL, TENURE],
        stats=("mean", "std", "median"),
        unseen="zero",
    ),
    *[
        StatBlock(pair, (MONTHLY, TENURE), _MEANS, deviation=False)
        for pair in _KEY_PAIRS
    ],
)

_RATIOS = ("avg_spend", "tenure_proxy", "charge_tenure", "charge_tenure_log", "charge_ratio")
_COUNTS = ("n_services", "n_internet", "n_security", "n_streaming")
_FLAGS = ("fiber", "dsl", "has_internet", "month_to_month", "echeck")
_PAIRED = (
    "tenure_x_monthly",
    "month_to_month_x_tenure",
    "fiber_x_MonthlyCharges",
    "echeck_mtm",
    "security_fiber",
    "senior_mtm",
)
_SIX_BINS = ("tenure_bin_six", "monthly_bin_six")
_ENSEMBLE = (*_RATIOS, *_COUNTS, *_FLAGS, *_PAIRED, *_SIX_BINS)
_RULES = ("fiber_unsecured", "new_mtm", "risk_score")
_GAPS = ("expected_total", "total_gap", "total_gap_share")
_ALL_BINS = ("tenure_bin_seven", "monthly_bin_seven", "total_bin")

_EXHAUSTIVE = (
    *_RATIOS,
    *("tenure_squared", "monthly_squared", "tenure_log", "monthly_log", "total_log"),
    *_GAPS,
    *_COUNTS,
    *("n_no_internet", "n_no", "cost_per_service", "cost_per_internet"),
    *_FLAGS,
    *("one_year", "two_year", "autopay"),
    *_crossed(CROSSED_FLAGS, [TENURE, MONTHLY, TOTAL]),
    *("echeck_mtm", "fiber_mtm", "senior_mtm", "senior_fiber", "security_fiber"),
    *("autopay_two_year", "no_internet_mtm"),
    *("fiber_unsecured", "mtm_high_charge", "new_mtm", "senior_fiber_echeck"),
    *_ALL_BINS,
)
_SLIM = (
    *_RATIOS,
    *("tenure_squared", "monthly_squared"),
    *_GAPS,
    *_COUNTS,
    "cost_per_service",
    *_FLAGS,
    "autopay",
    *_crossed(CROSSED_FLAGS, [TENURE, MONTHLY, TOTAL]),
    *("echeck_mtm", "fiber_mtm", "senior_mtm", "security_fiber"),
    *_RULES,
    *_ALL_BINS,
)
_WIDE = (
    *_RATIOS,
    *_COUNTS,
    "n_no_internet",
    *_SIX_BINS,
    *_FLAGS,
    *_PAIRED,
)
_FOUR_FLAGS = ["month_to_month", "fiber", "echeck", "autopay"]
_SHORT_CROSS = _crossed(_FOUR_FLAGS, [TENURE, MONTHLY])

_LISTED = (
    FeaturePlan(
        "fast",
        ("avg_spend", "tenure_proxy", "charge_tenure", "n_services", "fiber", "month_to_month",
         "echeck", "tenure_x_monthly"),
    ),
    FeaturePlan(
        "baseline",
        ("avg_spend", "tenure_proxy_by_one", "charge_tenure", "n_active", "tenure_bin_from_zero",
         "monthly_bin_from_zero", "has_internet"),
    ),
    FeaturePlan(
        "quick",
        ("avg_spend", "tenure_proxy", "charge_tenure", "n_services", *_SIX_BINS, "has_internet",
         "fiber", "month_to_month", "echeck", "tenure_x_monthly", "month_to_month_x_tenure"),
    ),
    FeaturePlan("wide", _WIDE, frequency=True),
    FeaturePlan("ensemble", _ENSEMBLE, frequency=True),
    FeaturePlan("ensemble_target", _ENSEMBLE, frequency=True, target_encoding=True),
    FeaturePlan(
        "wide_target",
        tuple(f for f in _WIDE if f not in ("n_no_internet", "dsl")),
        frequency=True,
        target_encoding=True,
    ),
    FeaturePlan("exhaustive", _EXHAUSTIVE, FULL_STATS, frequency=True),
    FeaturePlan(
        "plain",
        ("avg_spend", "tenure_proxy", "charge_tenure", "charge_ratio", "n_services", "fiber",
         "month_to_month", "echeck", "expected_total", "total_gap"),
        label_codes=False,
    ),
    FeaturePlan(
        "stacked", (*_ENSEMBLE, "autopay", "expected_total", "total_gap", *_RULES), frequency=True
    ),
    FeaturePlan(
        "exhaustive_risk",
        tuple("risk_score" if f == "no_internet_mtm" else f for f in _EXHAUSTIVE),
        FULL_STATS,
        frequency=True,
    ),
    FeaturePlan(
        "lite",
        (*_RATIOS, "tenure_squared", "monthly_log", "total_log", *_GAPS, *_COUNTS,
         "cost_per_service", *_FLAGS, "autopay", *_PAIRED, *_RULES, "tenure_bin_seven",
         "monthly_bin_seven"),
        LITE_STATS,
        frequency=True,
    ),
    FeaturePlan("slim", _SLIM, FULL_STATS, frequency=True, uses_external=False),
    FeaturePlan(
        "evidence",
        _SLIM,
        FULL_STATS,
        ranks=(
            *[RankSpec(v, g) for g in _MAIN_KEYS for v in (MONTHLY, TOTAL, TENURE)],
            *[RankSpec(v) for v in (MONTHLY, TOTAL, TENURE, "avg_spend")],
        ),
        clusters=ClusterPlan((TENURE, MONTHLY, TOTAL, "n_services", "n_internet", "avg_spend")),
        frequency=True,
        woe=True,
    ),
    FeaturePlan(
        "solo",
        (*_RATIOS, "expected_total", "total_gap", "n_services", "n_security", *_FOUR_FLAGS,
         *_SHORT_CROSS, "echeck_mtm", "security_fiber", *_RULES),
        uses_external=False,
    ),
    FeaturePlan(
        "set_a",
        ("avg_spend", "charge_tenure", "n_services", "month_to_month", "echeck"),
        uses_external=False,
    ),
    FeaturePlan("set_b", ("avg_spend", "charge_tenure"), HEAVY_STATS, uses_external=False),
    FeaturePlan(
        "set_c",
        ("avg_spend", "tenure_proxy", "charge_tenure", "charge_ratio", "expected_total",
         "total_gap", "n_services", "n_security", *_FOUR_FLAGS, *_SHORT_CROSS, "echeck_mtm",
         "fiber_mtm", "senior_mtm", "security_fiber", *_RULES, "cost_per_service"),
        uses_external=False,
    ),
    FeaturePlan(
        "set_d",
        (*_RATIOS, "tenure_squared", "monthly_squared", *_GAPS, "n_services", "n_internet",
         "n_security", "cost_per_service", *_FLAGS, "autopay",
         *_crossed(CROSSED_FLAGS, [TENURE, MONTHLY]), "echeck_mtm", "security_fiber", *_RULES,
         "tenure_bin_seven", "monthly_bin_seven"),
        MEAN_STATS,
        frequency=True,
        uses_external=False,
    ),
)

PLANS: dict[str, FeaturePlan] = {plan.name: plan for plan in _LISTED}
