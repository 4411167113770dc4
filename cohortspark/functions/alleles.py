"""Column expressions over alleles and genotype calls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: letters an allele may hold to be classified.
ALLELE_LETTERS = "ACGTNM"


def shared_head(a: Column, b: Column) -> Column:
    """Length of the longest common prefix that leaves one letter on each side; linear in the alleles."""
    most = F.least(F.length(a), F.length(b)) - 1
    letters = [F.split(F.substr(x, F.lit(1), most), "") for x in (a, b)]
    differ = F.array_position(F.zip_with(*letters, lambda x, y: x != y), F.lit(True)).cast("int")
    return F.when(most <= 0, 0).when(differ == 0, most).otherwise(differ - 1)


def _plain(allele: Column) -> Column:
    return (allele != "") & (F.translate(allele, ALLELE_LETTERS, "") == "")


def _ring(allele: Column) -> Column:
    """Purines as R, pyrimidines as Y: a transition leaves this unchanged."""
    return F.translate(allele, "AGCT", "RRYY")


def _extends(longer: Column, shorter: Column) -> Column:
    """``longer`` is ``shorter`` with bases put in after its first base."""
    return (F.left(longer, F.lit(1)) == F.left(shorter, F.lit(1))) & F.endswith(longer, F.substr(shorter, F.lit(2)))


def allele_class(ref: Column, alt: Column) -> Column:
    """``ti``, ``tv``, ``ins``, ``del`` or ``other`` for one alternate allele.

    A SNP may be written with shared bases around it: equal length, exactly one difference.
    """
    # Between strings of one length a single edit is a substitution.
    one_change = F.when(F.length(ref) == 1, ref != alt).otherwise(F.levenshtein(ref, alt, 1) == 1)
    return (
        F.when(ref.isNull() | alt.isNull() | ~(_plain(ref) & _plain(alt)), "other")
        .when(
            F.length(ref) == F.length(alt),
            F.when(~one_change, "other").when(_ring(ref) == _ring(alt), "ti").otherwise("tv"),
        )
        .when((F.length(ref) < F.length(alt)) & _extends(alt, ref), "ins")
        .when((F.length(ref) > F.length(alt)) & _extends(ref, alt), "del")
        .otherwise("other")
    )


def genotype_ends(gt: Column) -> Column:
    """``struct(first, last, several)`` of GT text: the numbers before the first and behind the last sign, and whether there is a sign."""
    slashed = F.translate(gt, "|", "/")
    return F.struct(
        F.substring_index(slashed, "/", 1).try_cast("int").alias("first"),
        F.substring_index(slashed, "/", -1).try_cast("int").alias("last"),
        F.contains(slashed, F.lit("/")).alias("several"),
    )


def called_alleles(ends: Column) -> Column:
    """``struct(a1, a2)`` of what ``genotype_ends`` gives."""
    return F.struct(
        F.when(ends["last"].isNotNull(), ends["first"]).alias("a1"),
        F.when(ends["first"].isNotNull() & ends["several"], ends["last"]).alias("a2"),
    )


def genotype_alleles(gt: Column) -> Column:
    """``struct(a1, a2)`` from GT text; phasing is ignored.

    A half-missing diploid call (``./1``) becomes missing as a whole, so a NULL ``a2``
    beside a set ``a1`` always means a haploid call.
    """
    return called_alleles(genotype_ends(gt))


def zygosity(a1: Column, a2: Column, haploid_as_hom: bool = False) -> Column:
    """``het``, ``hom`` (two copies of one alternate) or NULL."""
    result = F.when(a1 != a2, "het").when((a1 == a2) & (a1 > 0), "hom")
    if haploid_as_hom:
        result = result.when(a2.isNull() & (a1 > 0), "hom")
    return result


def call_passes(ft: Column) -> Column:
    """Genotype filter: no FT, or FT text holding ``PASS`` anywhere."""
    return ft.isNull() | F.contains(ft, F.lit("PASS"))


def site_passes(filters: Column) -> Column:
    """Site filter: FILTER missing or empty."""
    return filters.isNull() | (F.size(filters) == 0)
