from .cohort import CohortResults, CohortSettings, count_callset, run_cohort
from .intervals import downsample_context, downsample_file, probe_sets
from .report import build_report

__all__ = [
    "CohortResults", "CohortSettings", "build_report", "count_callset", "downsample_context", "downsample_file", "probe_sets", "run_cohort",
]
