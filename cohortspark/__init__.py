"""Cohort comparison on Spark: counts per sample and interval set, compared between groups."""

from .operators.bed import breakdown, downsample, interval_summary
from .operators.counting import derived_metrics, group_summaries, sample_counts
from .operators.labels import merge_labels, subsample
from .operators.membership import attach_sets, membership
from .operators.pairwise import compare_groups
from .operators.pca import metric_pca
from .operators.report import (
    cross_ancestry, distributions, flagged, group_means, heatmap, sample_sizes, volcano,
)
from .plans import CohortSettings, build_report, downsample_context, downsample_file, probe_sets, run_cohort
from .sources.callset import cached_import, import_vcf, read_callset
from .sources.intervals import read_bed, read_site_sets
from .sources.labels import read_ancestry, read_groups
from .sources.vcf import read_vcf

__all__ = [
    "CohortSettings", "attach_sets", "breakdown", "build_report", "cached_import", "compare_groups",
    "cross_ancestry", "derived_metrics", "distributions", "downsample", "downsample_context", "downsample_file",
    "flagged", "group_means", "group_summaries", "heatmap", "import_vcf", "interval_summary", "membership",
    "merge_labels", "metric_pca", "probe_sets", "read_ancestry", "read_bed", "read_callset", "read_groups",
    "read_site_sets", "read_vcf", "run_cohort", "sample_counts", "sample_sizes", "subsample", "volcano",
]
