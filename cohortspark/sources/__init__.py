from . import callset, files, intervals, labels, results, vcf

__all__ = ["callset", "files", "intervals", "labels", "results", "vcf"]
