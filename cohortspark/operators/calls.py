"""Site rows and long calls: splitting, filtering, classifying, exploding.

Site row: ``contig, pos, ref, alts ARRAY<STRING>, filters ARRAY<STRING>, af ARRAY<DOUBLE>,
ac ARRAY<INT>, calls ARRAY<STRUCT<sample_no, sample_id, a1, a2, ft>>``; sample_no may be missing. After ``split_alleles`` or
``first_allele``, ``alts`` has become ``alt``.
Long call: ``sample_id, contig, pos, ref, alt, a1, a2, ft``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import alleles
from .samples import is_wanted


def split_alleles(sites: DataFrame) -> DataFrame:
    """One row per alternate allele, in minimal form; AF and AC stay those of the whole site.

    Calls are recoded to this alternate (1) against everything else (0), so ``1/2`` is
    heterozygous in both rows. ``*`` and ``.`` give no row.
    """
    rest = [c for c in sites.columns if c not in ("contig", "pos", "ref", "alts", "calls")]
    each = sites.select(
        "contig", "pos", "ref", "calls", *rest, F.posexplode("alts").alias("_i", "_alt")
    ).filter(~F.col("_alt").isin("*", "."))
    number = F.col("_i") + 1

    def recode(call: Column) -> Column:
        return call.withField("a1", (call["a1"] == number).cast("int")).withField("a2", (call["a2"] == number).cast("int"))

    return trim_alleles(each.withColumnRenamed("_alt", "alt")).select(
        "contig", "pos", "ref", "alt", *rest, F.transform("calls", recode).alias("calls")
    )


def trim_alleles(rows: DataFrame) -> DataFrame:
    """Minimal form: drop the bases ref and alt share at the end, then those at the start.

    Bases dropped at the start move ``pos``. One base is always left on each side.
    """
    c = F.col
    tail = alleles.shared_head(F.reverse("ref"), F.reverse("alt"))
    rows = rows.withColumn("_tail", tail).withColumns({
        "ref": F.substr(c("ref"), F.lit(1), F.length("ref") - c("_tail")),
        "alt": F.substr(c("alt"), F.lit(1), F.length("alt") - c("_tail")),
    })
    return rows.withColumn("_head", alleles.shared_head(c("ref"), c("alt"))).withColumns({
        "ref": F.substr(c("ref"), c("_head") + 1),
        "alt": F.substr(c("alt"), c("_head") + 1),
        "pos": c("pos") + c("_head"),
    }).drop("_tail", "_head")


def first_allele(sites: DataFrame) -> DataFrame:
    """Sites left unsplit: class by the first alternate, calls as they are."""
    rest = [c for c in sites.columns if c not in ("contig", "pos", "ref", "alts")]
    return sites.select("contig", "pos", "ref", F.get(F.col("alts"), 0).alias("alt"), *rest)


def frequent_sites(sites: DataFrame, min_af: float = 0.01, min_ac: int = 100) -> DataFrame:
    """Sites with max(AF) or max(AC) above its threshold (strict); unknown on both counts as no."""
    return sites.filter((F.array_max("af") > min_af) | (F.array_max("ac") > min_ac))


def passing_sites(sites: DataFrame) -> DataFrame:
    """Sites whose FILTER is missing or empty."""
    return sites.filter(alleles.site_passes(F.col("filters")))


def passing_calls(calls: DataFrame) -> DataFrame:
    """Mask genotypes whose FT fails; the row stays, as a missing call."""
    keep = alleles.call_passes(F.col("ft"))
    return calls.withColumn("a1", F.when(keep, F.col("a1"))).withColumn("a2", F.when(keep, F.col("a2")))


def _carrier(a1: Column, a2: Column) -> Column:
    return (F.coalesce(a1, F.lit(0)) > 0) | (F.coalesce(a2, F.lit(0)) > 0)


def numbered(sites: DataFrame) -> bool:
    """Whether the calls carry the sample's place in the header."""
    return "sample_no" in sites.schema["calls"].dataType.elementType.fieldNames()


def explode_carriers(sites: DataFrame, filter_ft: bool = True, wanted: Column | None = None) -> DataFrame:
    """Long calls of a site row, keeping only calls that some counter can count.

    Counters look at het and hom-alt calls alone, so homozygous-reference, missing and
    masked calls are dropped inside the array, before any row is made of them, as are those of samples
    that are not ``wanted`` (the scalar of ``wanted_words``; calls must be numbered).
    """
    if wanted is not None:
        sites = sites.withColumn("_words", wanted)

    def counts(call: Column) -> Column:
        kept = _carrier(call["a1"], call["a2"])
        if filter_ft:
            kept = kept & alleles.call_passes(call["ft"])
        return kept if wanted is None else is_wanted(F.col("_words"), call["sample_no"]) & kept

    rest = [c for c in sites.columns if c not in ("calls", "_words")]
    return sites.select(*rest, F.explode(F.filter("calls", counts)).alias("_call")).select(
        *rest, "_call.sample_id", "_call.a1", "_call.a2", "_call.ft"
    )


def carriers(calls: DataFrame, filter_ft: bool = True) -> DataFrame:
    """The same choice on long calls: those with an alternate allele that are not masked.

    It tests stored columns only. A filter on the computed class or zygosity would be pushed
    below their projection and drag a second copy of both expressions into the scan's
    generated code, past the size the JVM compiles.
    """
    kept = calls.filter(_carrier(F.col("a1"), F.col("a2")))
    return kept.filter(alleles.call_passes(F.col("ft"))) if filter_ft else kept


def classify(rows: DataFrame) -> DataFrame:
    """Add ``allele_class``; do it on sites, before exploding, where sites are at hand."""
    return rows.withColumn("allele_class", alleles.allele_class(F.col("ref"), F.col("alt")))


def with_zygosity(calls: DataFrame, haploid_as_hom: bool = False) -> DataFrame:
    return calls.withColumn("zygosity", alleles.zygosity(F.col("a1"), F.col("a2"), haploid_as_hom))


def keep_samples(calls: DataFrame, labels: DataFrame, broadcast_ids: int = 2_000_000) -> DataFrame:
    """Only calls of labelled samples. The id list is broadcast up to a counted size, else joined by shuffle."""
    ids = labels.select("sample_id").distinct()
    small = labels.count() <= broadcast_ids
    return calls.join(F.broadcast(ids) if small else ids, "sample_id", "left_semi")
