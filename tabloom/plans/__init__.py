from tabloom.plans.build import FeatureTable, build_features
from tabloom.plans.kept import FittedPlan, KeptRun, load_run
from tabloom.plans.plan import FeaturePlan
from tabloom.plans.presets import PRESETS, Preset, run_presets
from tabloom.plans.runs import RunResult, prepare, run_plan
from tabloom.plans.subscription import PLANS, ROW_FEATURES

__all__ = [
    "PLANS",
    "PRESETS",
    "ROW_FEATURES",
    "FeaturePlan",
    "FeatureTable",
    "FittedPlan",
    "KeptRun",
    "Preset",
    "RunResult",
    "build_features",
    "load_run",
    "prepare",
    "run_plan",
    "run_presets",
]
