from .tables import sampled_rows, write_bed, write_results, write_tsv

__all__ = ["sampled_rows", "write_bed", "write_results", "write_tsv"]
