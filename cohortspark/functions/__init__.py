from . import alleles, metrics, student

__all__ = ["alleles", "metrics", "student"]
