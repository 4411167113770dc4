from . import bed, calls, counting, labels, membership, pairwise, pca, ranking, report

__all__ = ["bed", "calls", "counting", "labels", "membership", "pairwise", "pca", "ranking", "report"]
