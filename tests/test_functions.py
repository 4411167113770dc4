import math

import pytest
from pyspark.sql import functions as F

from cohortspark.functions import alleles, metrics, student
from cohortspark.operators import pairwise


def column(spark, values, schema, *exprs):
    rows = spark.createDataFrame(values, schema).coalesce(1).select(*exprs).collect()
    return [tuple(r) if len(exprs) > 1 else r[0] for r in rows]


CLASSES = [
    ("A", "G", "ti"), ("C", "T", "ti"), ("A", "C", "tv"), ("G", "T", "tv"), ("A", "AT", "ins"), ("ATG", "A", "del"),
    ("AT", "GC", "other"), ("A", "*", "other"), ("A", "<DEL>", "other"), ("AC", "AT", "ti"), ("ACA", "AGA", "tv"),
    ("A", "A", "other"), ("a", "G", "other"), ("AT", "CAT", "other"), ("ATT", "AGTT", "ins"), ("A", "N", "tv"),
    ("A", None, "other"), ("AGT", "TGA", "other"), ("ACG", "CGA", "other"),
]


def test_allele_class(spark):
    got = column(spark, CLASSES, "ref string, alt string, want string", alleles.allele_class(F.col("ref"), F.col("alt")))
    assert got == [c[2] for c in CLASSES]


@pytest.mark.parametrize("haploid", [False, True])
def test_zygosity(spark, haploid):
    cases = [("0/0", None), ("0/1", "het"), ("1|0", "het"), ("1/1", "hom"), ("./.", None), ("./1", None), ("1/.", None),
             ("1", "hom" if haploid else None), ("0", None), ("1/2", "het"), ("2|2", "hom"), (".", None)]
    pair = alleles.genotype_alleles(F.col("gt"))
    got = column(spark, cases, "gt string, want string", alleles.zygosity(pair["a1"], pair["a2"], haploid))
    assert got == [c[1] for c in cases]


def test_filters(spark):
    got = column(spark, [(None,), ([],), (["LowQual"],)], "f array<string>", alleles.site_passes(F.col("f")))
    assert got == [True, True, False]
    got = column(spark, [(None,), ("PASS",), ("xPASSy",), ("LowGQ",)], "ft string", alleles.call_passes(F.col("ft")))
    assert got == [True, True, True, False]


def test_ratio_and_number(spark):
    got = column(spark, [(4, 2), (4, 0)], "a int, b int", metrics.ratio(F.col("a"), F.col("b")))
    assert got == [2.0, None]
    got = column(spark, [("1.5",), ("x",), ("NaN",), (None,), ("",)], "v string", metrics.number(F.col("v")))
    assert got == [1.5, None, None, None, None]


def test_metric_names(spark):
    names = [("GC_gt_85_indel_total",), ("Low_Mappability_snp_ti_het",), ("_snp_total",), ("foo",), ("A_indel_ins_het",)]
    m = metrics.parse_metric(F.col("n"))
    assert column(spark, names, "n string", m["set_name"], m["metric_type"]) == [
        ("GC_gt_85", "indel_total"), ("Low_Mappability", "snp_ti_het"), ("unknown", "_snp_total"), ("unknown", "foo"),
        ("A", "indel_ins_het"),
    ]
    assert [metrics.parse_name(n) for n, in names] == [
        ("GC_gt_85", "indel_total"), ("Low_Mappability", "snp_ti_het"), ("unknown", "_snp_total"), ("unknown", "foo"),
        ("A", "indel_ins_het"),
    ]
    assert column(spark, [("titv_total",), ("x",)], "n string", metrics.display_metric(F.col("n"))) == ["Ti/Tv Ratio", "x"]


def test_severity_and_stars(spark):
    got = column(spark, [(0.5,), (-0.7,), (0.49,), (None,)], "d double", metrics.severity(F.col("d")))
    assert got == ["appreciable", "appreciable", "not appreciable", "not appreciable"]
    cells = [(0.125, 0.01), (-1.005, 0.05), (None, 0.01), (0.3, None)]
    assert column(spark, cells, "d double, p double", metrics.starred(F.col("d"), F.col("p"))) == [
        f"{0.125:.2f}*", f"{-1.005:.2f}", "", "0.30"]


def test_base_pairs(spark):
    got = column(spark, [(2386029433,), (248876769,), (544700,), (312,)], "bp bigint", metrics.base_pairs(F.col("bp")))
    assert got == ["2.39 Gbp", "248.9 Mbp", "544.7 Kbp", "312 bp"]


def density_tail(t, df, steps=200_000):
    """P(|T| >= t) by Simpson's rule on the substitution x = t + u / (1 - u)."""
    import numpy as np

    u = np.linspace(0, 1, steps + 1)[:-1]
    x = t + u / (1 - u)
    log_c = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
    y = np.exp(log_c - (df + 1) / 2 * np.log1p(x * x / df)) / (1 - u) ** 2
    y = np.append(y, 0.0)
    w = np.ones(steps + 1)
    w[1:-1:2], w[2:-1:2] = 4, 2
    return 2 * float((w * y).sum()) / (3 * steps)


def test_student_published_values(spark):
    cases = [(2.0, 10.0, 0.07338803477074), (1.0, 1.0, 0.5), (2.228138852, 10.0, 0.05), (12.0, 9998.3, 5.9803039396e-33),
             (40.0, 200.0, 2.2487396535e-97), (0.001, 5000.0, 0.99920215543), (0.0, 7.0, 1.0)]
    got = column(spark, cases, "t double, df double, p double", student.two_sided_p(F.col("t"), F.col("df")))
    for value, (_, _, want) in zip(got, cases):
        assert value == pytest.approx(want, rel=1e-8)


def test_student_against_integration(spark):
    grid = [(t, df) for t in (0.05, 0.7, 1.7, 1.75, 2.5, 6.0, -3.0) for df in (1.3, 4.0, 18.0, 99.5, 4000.0, 500_000.0)]
    got = column(spark, grid, "t double, df double", student.two_sided_p(F.col("t"), F.col("df")))
    for value, (t, df) in zip(got, grid):
        assert value == pytest.approx(density_tail(abs(t), df), rel=1e-5), (t, df)


def test_cohens_d_and_welch(spark):
    rows = [(float(v), "x") for v in range(1, 11)] + [(float(v), "y") for v in range(2, 12)]
    df = spark.createDataFrame(rows, "v double, g string")
    m = df.groupBy().agg(*[
        f(F.when(F.col("g") == g, F.col("v"))).alias(n + g)
        for g in "xy" for n, f in (("n", F.count), ("m", F.avg), ("s", F.stddev_pop), ("v", F.var_samp))
    ])
    c = F.col
    sides = m.toDF(*[f"{name}_{g}" for g in "xy" for name in ("n", "mean", "sd", "var")])
    row = student.with_welch_p(sides).withColumn(
        "d", pairwise.cohens_d(c("mean_x"), c("sd_x"), c("n_x"), c("mean_y"), c("sd_y"), c("n_y"))).first()
    assert row.d == pytest.approx(-1 / math.sqrt(8.25))
    assert row.p_value == pytest.approx(density_tail(1 / math.sqrt(2 * (55 / 6) / 10), 18.0), rel=1e-6)


def test_welch_constant_groups(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1.0, 0.0, 10), (1.0, 0.0, 2.0, 0.0, 10)],
                               "mean_x double, var_x double, mean_y double, var_y double, n_x bigint")
    rows = student.with_welch_p(df.withColumn("n_y", F.col("n_x"))).coalesce(1)
    got = rows.select("p_value", student.neg_log10(F.col("p_value"))).collect()
    assert [tuple(r) for r in got] == [(None, None), (0.0, None)]
