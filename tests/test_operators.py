import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cohortspark.operators import bed, bitmaps, calls as call_ops, counting, labels, membership, pairwise, pca, ranking, report
from cohortspark.operators.samples import wanted_words

INTERVALS = "set_name string, contig string, start int, end int"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# --- membership ---------------------------------------------------------------------------


def brute_membership(points, intervals):
    return sorted({
        (c, p, s) for c, p in points for s, ic, a, b in intervals if c == ic and a <= p <= b
    })


@pytest.mark.parametrize("way", [
    {}, {"broadcast_entries": 0, "min_hot_rows": 5, "large": "blocks"}, {"broadcast_entries": 0, "large": "blocks"}, {"block_bp": 7},
    {"broadcast_entries": 0}, {"broadcast_entries": 0, "cell_bp": 50},
])
def test_membership_against_brute_force(spark, way):
    rng = random.Random(1)
    intervals = [
        (rng.choice("AB"), rng.choice(["chr1", "chr2"]), s := rng.randint(1, 9000), s + rng.choice([0, 3, 40, 5000]))
        for _ in range(300)
    ]
    # A third of all intervals pile up in one place, a third of all points on one site.
    intervals += [("A", "chr1", 500, 500 + i % 50) for i in range(150)] + [("B", "chr1", 9, 3)]
    points = [(rng.choice(["chr1", "chr2", "chr3"]), rng.randint(1, 15000)) for _ in range(400)] + [("chr1", 510)] * 200
    got = membership.membership(
        spark.createDataFrame(points, "contig string, pos int"), spark.createDataFrame(intervals, INTERVALS), **way
    )
    assert rows_of(got) == brute_membership(points, [i for i in intervals if i[2] <= i[3]])


def test_hot_block_is_cut_and_whole(spark):
    """A third of the points are copies of one row; its block is cut, and no row is lost or doubled."""
    points = spark.range(30_000).repartition(8).selectExpr(
        "'chr1' AS contig", "CAST(CASE WHEN id % 3 = 0 THEN 700 ELSE id END AS INT) AS pos", "'s' AS sample_id")
    intervals = spark.createDataFrame([("A", "chr1", 650, 750), ("B", "chr1", 1, 20_000)], INTERVALS)
    keyed = points.withColumn("_blk", F.expr("CAST(pos DIV 128 AS INT)"))
    hot = {r._hot_block: r._parts for r in membership._hot_blocks(keyed, 1000).collect()}
    assert hot == {5: 11}
    way = {"block_bp": 128, "broadcast_entries": 0, "min_hot_rows": 1000, "large": "blocks"}
    got = membership.attach_sets(points, intervals, **way).groupBy("set_name").count()
    want = membership.attach_sets(points, intervals, block_bp=128).groupBy("set_name").count()
    assert rows_of(got) == rows_of(want) and got.count() == 2


def test_interval_ends_and_overlaps(spark):
    bed_like = spark.createDataFrame([("S", "chr1", 11, 20), ("S", "chr1", 15, 30), ("S", "chr1", 15, 30)], INTERVALS)
    points = spark.createDataFrame([("chr1", p) for p in (10, 11, 15, 20, 30, 31)], "contig string, pos int")
    got = membership.attach_sets(points, bed_like, block_bp=4)
    assert rows_of(got) == [("chr1", p, "S") for p in (11, 15, 20, 30)]


def test_pile_up_is_merged_inside_blocks(spark):
    piled = spark.range(5000).selectExpr(
        "'S' AS set_name", "'chr1' AS contig", "CAST(100 + id % 20 AS INT) AS start", "CAST(130 + id % 7 AS INT) AS end"
    )
    assert rows_of(membership.block_index(piled, 1024)) == [("S", "chr1", 0, 100, 136)]
    assert membership.index_bound(piled, 1024) == 5000


def test_membership_plans(spark):
    points = spark.range(1000).selectExpr("'chr1' AS contig", "CAST(id AS INT) AS pos", "id AS sample")
    intervals = spark.createDataFrame([("S", "chr1", 11, 20)], INTERVALS)
    for way in ({}, {"broadcast_entries": 0}, {"broadcast_entries": 0, "large": "blocks"}):
        df = membership.attach_sets(points, intervals, **way)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sweep_carries_open_intervals(spark):
    """A long interval is two steps and one carried row per cell, whatever lies in between; batches cut cells anywhere."""
    rng = random.Random(4)
    intervals = [("L", "chr1", 1, 9_999), ("M", "chr1", 700, 700), ("M", "chr1", 701, 760), ("N", "chr2", 5, 2_000), ("N", "chr2", 6, 1_500), ("L", None, 1, 5)]
    intervals += [(rng.choice("MN"), rng.choice(["chr1", "chr2"]), s := rng.randint(1, 9000), s + rng.choice([0, 9, 900])) for _ in range(200)]
    points = [(rng.choice(["chr1", "chr2", "chr3"]), rng.randint(0, 12_000)) for _ in range(3_000)] + [(None, 7), ("chr1", None)]
    frames = spark.createDataFrame(points, "contig string, pos int"), spark.createDataFrame(intervals, INTERVALS)
    want = brute_membership([p for p in points if None not in p], [i for i in intervals if i[1]])
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch, cell in ((10_000, 1 << 20), (7, 64), (1, 1_000)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            assert rows_of(membership.sweep_membership(*frames, cell_bp=cell)) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert membership.sweep_membership(frames[0].limit(0), frames[1]).count() == membership.sweep_membership(frames[0], frames[1].limit(0)).count() == 0


# --- counting -----------------------------------------------------------------------------


def test_counts_zero_fill_and_hot_sample(spark):
    carriers = spark.createDataFrame(
        [("hot", "S", "ti", "het")] * 50 + [("hot", "S", "other", "het"), ("b", "T", "del", "hom"), ("b", "T", "ins", None)],
        "sample_id string, set_name string, allele_class string, zygosity string",
    )
    samples = spark.createDataFrame([("hot",), ("b",), ("quiet",)], "sample_id string")
    counts = counting.sample_counts(carriers, samples, ["S", "T"])
    got = {(r.sample_id, r.set_name): (r.snp_ti_het, r.indel_del_hom, r.indel_ins_het) for r in counts.collect()}
    assert got == {("hot", "S"): (50, 0, 0), ("hot", "T"): (0, 0, 0), ("b", "S"): (0, 0, 0), ("b", "T"): (0, 1, 0),
                   ("quiet", "S"): (0, 0, 0), ("quiet", "T"): (0, 0, 0)}


def test_masked_calls_are_missing_not_dropped(spark):
    rows = spark.createDataFrame([("a", 0, 1, "LowGQ"), ("b", 1, 1, None)], "sample_id string, a1 int, a2 int, ft string")
    assert rows_of(call_ops.passing_calls(rows).select("sample_id", "a1", "a2")) == [("a", None, None), ("b", 1, 1)]
    assert [r.sample_id for r in call_ops.carriers(rows).collect()] == ["b"]


def test_keep_samples_both_ways(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "sample_id string, v int")
    wanted = spark.createDataFrame([("a", "x", "g"), ("a", "y", "g")], "sample_id string, ancestry string, grp string")
    assert rows_of(call_ops.keep_samples(rows, wanted)) == [("a", 1)]
    assert rows_of(call_ops.keep_samples(rows, wanted, broadcast_ids=0)) == [("a", 1)]
    gappy = spark.createDataFrame([("a", None, "g"), ("a", "z", "h")], "sample_id string, ancestry string, grp string")
    assert rows_of(counting.add_labels(rows, gappy)) == [("a", 1, "z", "h")]
    # A sample labelled twice is counted once, under its smallest label.
    assert rows_of(counting.add_labels(rows, wanted)) == [("a", 1, "x", "g")]


# --- labels and draws ---------------------------------------------------------------------


def md5(*parts):
    return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()


def test_merge_multiplies_duplicates(spark):
    a = spark.createDataFrame([("1", "eur"), ("1", "afr"), ("2", "eur")], "sample_id string, ancestry string")
    g = spark.createDataFrame([("1", "A"), ("3", "B")], "sample_id string, grp string")
    assert rows_of(labels.merge_labels(a, g)) == [("1", "afr", "A"), ("1", "eur", "A")]
    assert rows_of(labels.merge_labels(a, g, ["eur"], ["A"])) == [("1", "eur", "A")]
    assert rows_of(labels.unmatched_counts(a, g)) == [("ancestry", 1), ("group", 1)]


def test_subsample(spark):
    rows = [(f"s{i}", "eur", "A") for i in range(60)] + [(f"t{i}", "eur", "B") for i in range(49)]
    rows += [(f"u{i}", "afr", "A") for i in range(50)]
    df = spark.createDataFrame(rows, "sample_id string, ancestry string, grp string")
    got = rows_of(labels.subsample(df, 55, 50, seed=7))
    want = sorted(sorted(rows[:60], key=lambda r: md5(7, r[0]))[:55] + rows[109:])
    assert got == want
    assert rows_of(labels.subsample(df.repartition(7), 55, 50, seed=7)) == want
    assert labels.subsample(df, None) is df
    with pytest.raises(ValueError, match="below"):
        labels.subsample(df, 10, 50)
    with pytest.raises(ValueError, match="No groups"):
        labels.require_rows(labels.subsample(df, 500, 400))


def test_draw_with_a_third_of_rows_equal(spark):
    rows = [("dup", "g")] * 300 + [(f"s{i}", "g") for i in range(600)]
    df = spark.createDataFrame(rows, "sample_id string, grp string")
    got = [r.sample_id for r in ranking.first_n(df, ["grp"], 3, ["sample_id"], 450).collect()]
    want = sorted((r[0] for r in rows), key=lambda s: md5(3, s))[:450]
    assert sorted(got) == sorted(want)


def test_small_draws_keep_their_rows_in_the_tasks(spark):
    """The limit per stratum stands before the shuffle, and both ways draw the same rows."""
    df = spark.range(5_000).selectExpr("CAST(id AS STRING) AS sample_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', id % 7) END AS grp", "'x' AS ancestry")
    few = ranking.first_n(df, ["grp"], 3, ["sample_id"], 40)
    assert few._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
    drawn = ranking.repeat_rows(ranking.fit_budget(df, ["grp"], 3, ["sample_id"], None, F.lit(40).cast("bigint")), "_fits").select(*df.columns)
    assert rows_of(few) == rows_of(drawn)
    assert "WindowGroupLimit" in labels.subsample(df, 50, 50)._jdf.queryExecution().executedPlan().toString()


def test_quantile_rows_do_not_meet_by_stratum(spark):
    """Rows move by stratum, bucket and value at least; only partial results move by stratum alone."""
    df = spark.range(20_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'a' END AS g", "CAST(id % 7919 AS DOUBLE) AS v").repartition(8)
    found = ranking.exact_quantiles(df, ["g"], "v", {"q": 0.5})
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    for k, line in enumerate(lines):
        if "Exchange hashpartitioning(g#" in line and "_slice" not in line:
            assert "partial_" in lines[k + 1] or "_slice" in "".join(lines[k + 1 : k + 3]), lines[k : k + 3]
    import numpy as np

    for r in found.collect():
        assert r.q == np.median([i % 7919 for i in range(20_000) if (i % 3 == 0) == (r.g == "a")])


def test_repeat_rows_past_one_block(spark):
    df = spark.createDataFrame([("a", 25_001), ("b", 0), ("c", 10_000)], "k string, n bigint")
    assert rows_of(ranking.repeat_rows(df, "n").groupBy("k").count()) == [("a", 25_001), ("c", 10_000)]


def test_quantile_buckets_fit_the_values(spark):
    """Values within a third of a per cent of each other still spread over the buckets."""
    rows = spark.range(200_000).selectExpr("CASE WHEN id % 2 = 0 THEN 'a' END AS g", "CAST(4000000 + id / 20 AS DOUBLE) AS v")
    sizes = [r["count"] for r in ranking.fitted_buckets(rows, ["g"], "v").groupBy("g", "_slice").count().collect()]
    assert len(sizes) == 128 and max(sizes) < 3 * 200_000 / 128 and sum(sizes) == 200_000


def test_exact_quantiles(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    groups = {"a": list(rng.normal(0, 5, 501)), "b": [3.0] * 400, "c": [1e12, -1e12, 0.5, 0.25], "d": [7.0]}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in ranking.exact_quantiles(df, ["g"], "v", {"q1": 0.25, "median": 0.5, "q3": 0.75}).collect()}
    for g, values in groups.items():
        r = got[g]
        assert (r.n, r.min, r.max) == (len(values), min(values), max(values))
        assert [r.q1, r.median, r.q3] == pytest.approx(list(np.percentile(values, [25, 50, 75])))


# --- comparisons --------------------------------------------------------------------------


def sample_table(spark, rows):
    """Rows of (sample, ancestry, group, value); the value feeds all key metrics."""
    df = spark.createDataFrame(rows, "sample_id string, ancestry string, grp string, v double")
    return df.select("*", F.lit("S").alias("set_name"), *[
        F.col("v").alias(m) for m in ("snp_total", "indel_total", "titv_total", "delins_total")])


def test_minimums_have_their_own_units(spark):
    rows = [(f"a{i}", "eur", "A", float(i)) for i in range(50)]
    rows += [(f"b{i}", "eur", "B", float(i) if i < 10 else None) for i in range(50)]
    rows += [(f"c{i}", "eur", "C", float(i) if i < 9 else None) for i in range(60)]
    rows += [(f"d{i}", "eur", "D", float(i)) for i in range(49)]
    got = pairwise.compare_groups(sample_table(spark, rows), "g")
    assert {(r.group_x, r.group_y) for r in got.collect()} == {("A", "B")}
    assert got.first().n_y == 10


def test_swap_and_ddof(spark):
    rng = random.Random(5)
    rows = [(f"{g}{i}", "eur", g, rng.gauss(k, 1 + k)) for k, g in enumerate("AB") for i in range(30)]
    table = sample_table(spark, rows)
    ab = pairwise.compare_groups(table, "g", 10).filter("metric_type = 'snp_total'").first()
    ba = pairwise.compare_groups(table, "g", 10, group_order=["B", "A"]).filter("metric_type = 'snp_total'").first()
    assert (ba.group_x, ba.cohens_d, ba.p_value) == ("B", pytest.approx(-ab.cohens_d), pytest.approx(ab.p_value))
    book = pairwise.compare_groups(table, "g", 10, ddof=1).filter("metric_type = 'snp_total'").first()
    assert abs(book.cohens_d) < abs(ab.cohens_d)
    assert ab.metric == "S_snp_total" and ab.neg_log10_p > 0


def test_shuffled_labels_show_no_effect(spark):
    rng = random.Random(11)
    values = [rng.gauss(100, 10) + (15 if i % 2 else 0) for i in range(400)]
    rng.shuffle(values)
    rows = [(f"s{i}", "eur", "AB"[i % 2], v) for i, v in enumerate(values)]
    worst = pairwise.compare_groups(sample_table(spark, rows), "g").agg(F.max(F.abs("cohens_d"))).first()[0]
    assert worst < 0.35


def test_constant_groups_have_no_effect_size(spark):
    rows = [(f"{g}{i}", "eur", g, v) for g, v in (("A", 1.0), ("B", 1.0), ("C", 2.0)) for i in range(12)]
    got = {(r.group_x, r.group_y): (r.cohens_d, r.p_value, r.neg_log10_p)
           for r in pairwise.compare_groups(sample_table(spark, rows), "g", 10).collect()}
    assert got == {("A", "B"): (None, None, None), ("A", "C"): (None, 0.0, None), ("B", "C"): (None, 0.0, None)}


def test_summaries_keep_conventions(spark):
    table = sample_table(spark, [("a", "eur", "A", 1.0), ("b", "eur", "A", 3.0), ("c", "eur", "B", 5.0), ("d", None, "B", 5.0)])
    counts = table.select("sample_id", "ancestry", "grp", "set_name", *[F.lit(1).cast("bigint").alias(c) for c in counting.metrics.COUNTERS])
    full = counting.derived_metrics(counts).withColumn("snp_total", F.lit(4).cast("bigint"))
    long = counting.group_summaries(full).filter("metric_type = 'snp_total'").collect()
    assert {(r.grp, r["mean"], r["std"], r["count"]) for r in long} == {("A", 4.0, 0.0, 2), ("B", 4.0, None, 1)}
    wide = counting.group_summaries_wide(full, ["S", "T"])
    assert "S_snp_total_mean" in wide.columns and "T_titv_het_count" in wide.columns and wide.count() == 2


# --- report -------------------------------------------------------------------------------

COMPARISONS = [
    ("afr", "A", "B", "S_snp_total", 0.5, 0.05), ("afr", "A", "B", "S_titv_total", -0.7, 0.2),
    ("afr", "A", "C", "S_snp_total", 0.51, None), ("afr", "A", "C", "S_snp_het", 0.1, 0.01),
    ("eur", "A", "B", "S_snp_total", 0.1, 1e-9), ("eur", "A", "B", "S_titv_total", -0.6, 0.6),
    ("eur", "A", "C", "S_snp_total", None, 0.001), ("eur", "B", "C", "T_snp_total", 0.2, 0.3),
]


@pytest.fixture(scope="module")
def compared(spark):
    df = spark.createDataFrame(
        COMPARISONS, "ancestry string, group_x string, group_y string, metric string, cohens_d double, p_value double"
    )
    return df.withColumn("neg_log10_p", -F.log10("p_value")).withColumn("n_x", F.lit(9)).withColumn("n_y", F.lit(8))


def test_flags(compared):
    rows = report.flagged(compared)
    assert {(r.ancestry, r.metric, r.group_pair, r.severity) for r in rows.collect()} == {
        ("afr", "S_titv_total", "A vs B", "appreciable"), ("afr", "S_snp_total", "A vs C", "appreciable"),
        ("afr", "S_snp_het", "A vs C", "not appreciable"), ("eur", "S_snp_total", "A vs B", "not appreciable"),
        ("eur", "S_titv_total", "A vs B", "appreciable"), ("eur", "S_snp_total", "A vs C", "not appreciable"),
    }
    assert tuple(report.flag_totals(compared).first()) == (8, 6, 3)
    assert [r.abs_d for r in report.flagged_top(rows, 3).collect()] == [0.7, 0.6, 0.51]
    assert report.flagged_top(rows, 20).collect()[-1].abs_d is None
    assert rows_of(report.most_affected_sets(rows)) == [("S", 6)]


def test_heatmap(compared):
    cells = report.heatmap(compared, report.pair_names(["C", "A", "B"]), "cell_text")
    got = {(r.ancestry, r.row_label): (r["A vs B"], r["A vs C"], r["B vs C"]) for r in cells.collect()}
    assert got == {
        ("afr", "S / SNP Count"): ("0.50", "0.51", None), ("afr", "S / Ti/Tv Ratio"): ("-0.70", None, None),
        ("eur", "S / SNP Count"): ("0.10*", "", None), ("eur", "S / Ti/Tv Ratio"): ("-0.60", None, None),
        ("eur", "T / SNP Count"): (None, None, "0.20"),
    }


def test_volcano(spark, compared):
    rows = report.volcano(compared)
    assert rows.first().bonferroni == pytest.approx(2.20411998)
    assert rows.filter("labelled").count() == 0 and rows.filter("beyond_threshold").count() == 3
    assert report.bonferroni_line(compared.limit(0)) is not None
    assert report.volcano(compared.filter("ancestry = 'nobody'")).count() == 0


def test_cross_ancestry(compared):
    rows = report.cross_ancestry(compared)
    got = {r.comparison_key: (r.ancestry_x, r.d_x, r.ancestry_y, r.d_y, r.labelled) for r in rows.collect()}
    assert got == {
        "A vs B | S_snp_total": ("afr", 0.5, "eur", 0.1, True), "A vs B | S_titv_total": ("afr", -0.7, "eur", -0.6, True),
        "A vs C | S_snp_total": ("afr", 0.51, "eur", None, True),
    }
    r = report.cross_correlation(rows).first()
    assert r.n_matched == 3 and r.r == pytest.approx(1.0)
    assert report.cross_ancestry(compared, "eur", "afr").first().ancestry_x == "eur"


def test_sample_sizes(compared):
    table = report.sample_size_table(compared, ["afr", "eur"])
    assert {(r.grp, r.afr, r.eur) for r in table.collect()} == {("A", 9, 9), ("B", 8, 9), ("C", 8, 8)}


def test_group_means_fill_absent_cells_only(spark):
    rows = [("afr", "A", "S", "snp_total", 1.0, None), ("afr", "B", "S", "snp_total", 2.0, 0.5), ("eur", "A", "S", "snp_total", 3.0, 0.1)]
    df = spark.createDataFrame(rows, "ancestry string, grp string, set_name string, metric_type string, mean double, std double")
    got = {(r.ancestry, r.grp): (r["mean"], r["std"]) for r in report.group_means(df).collect()}
    assert got == {("afr", "A"): (1.0, None), ("afr", "B"): (2.0, 0.5), ("eur", "A"): (3.0, 0.1), ("eur", "B"): (0.0, 0.0)}


def test_pca_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    blocks = {"big": rng.normal(size=(600, 5)) @ rng.normal(size=(5, 5)), "small": rng.normal(size=(9, 5)), "mid": rng.normal(size=(40, 5)) + 1e3}
    blocks["mid"][:, 2] = 4.0
    rows = [(k, f"{k}{i}", *map(float, r)) for k, b in blocks.items() for i, r in enumerate(b)]
    rows[0] = (*rows[0][:2], None, *rows[0][3:])
    blocks["big"][0, 0] = 0.0
    names = [f"m.{i}" for i in range(5)]
    df = spark.createDataFrame(rows, ["ancestry", "sample_id", *names]).repartition(6)
    got = pca.metric_pca(df, names, "ancestry", ["sample_id"]).toPandas().set_index("sample_id")
    assert set(got.ancestry) == {"big", "mid"}
    assert pca.metric_pca(df, names[:2], "ancestry", ["sample_id"]) is None
    assert len(pca.metric_pca(df, names, "ancestry", ["sample_id"], max_samples=20).toPandas()) == 40
    for k in ("big", "mid"):
        x = blocks[k]
        z = x - x.mean(axis=0)
        z = z / np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
        _, s, v = np.linalg.svd(z, full_matrices=False)
        mine = got.loc[[f"{k}{i}" for i in range(len(x))]]
        for j, name in enumerate(("pc1", "pc2")):
            axis = v[j] * (1 if v[j][np.abs(v[j]).argmax()] >= 0 else -1)
            assert mine[name].to_numpy() == pytest.approx(z @ axis, abs=1e-6)
            assert mine[f"percent_{j + 1}"].iloc[0] == pytest.approx(100 * s[j] ** 2 / (s**2).sum())


# --- interval tools -----------------------------------------------------------------------


def bed_rows(spark, rows):
    return bed.standard_intervals(spark.createDataFrame(rows, "contig string, start0 int, end0 int"))


def draw(rows, seed):
    return sorted(rows, key=lambda r: md5(seed, *r))


def brute_downsample(rows, target, stratify, seed):
    total = sum(b - a for _, a, b in rows)
    if target >= total:
        return sorted(rows)
    groups = {}
    for r in draw(rows, seed):
        groups.setdefault(r[0] if stratify else "all", []).append(r)
    kept = []
    for group in groups.values():
        whole = sum(b - a for _, a, b in group)
        budget = max(1, int(target * whole / total)) if stratify else target
        run, mine = 0, []
        for r in group:
            run += r[2] - r[1]
            if run <= budget:
                mine.append(r)
        if not mine:
            mine = [min(group, key=lambda r: (r[2] - r[1], md5(seed, *r)))] if stratify else group[:1]
        kept += mine
    return sorted(kept)


@pytest.mark.parametrize("stratify", [True, False])
@pytest.mark.parametrize("target", [1, 2000, 30_000, 10**9])
def test_downsample_against_brute_force(spark, stratify, target):
    rng = random.Random(2)
    rows = [(rng.choice(["chr1", "chr2", "chrX"]), s := rng.randint(0, 10**6), s + rng.randint(1, 400)) for _ in range(400)]
    rows += [("chr1", 77, 177)] * 200  # a third of all rows are copies of one interval
    got = bed.downsample(bed_rows(spark, rows).repartition(5), target, stratify, seed=42)
    assert sorted((r.contig, r.start0, r.end0) for r in got.collect()) == brute_downsample(rows, target, stratify, 42)


def test_downsample_odd_widths(spark):
    rows = [("chr1", 10, 10), ("chr1", 50, 40), ("chr1", 50, 40), ("chr1", 0, 100), ("chr2", 5, 60)]
    for stratify in (True, False):
        got = bed.downsample(bed_rows(spark, rows), 80, stratify, seed=1)
        assert sorted((r.contig, r.start0, r.end0) for r in got.collect()) == brute_downsample(rows, 80, stratify, 1)


def test_uniform_draw_orders_no_more_than_a_bucket_together(spark):
    df = bed_rows(spark, [("chr1", i, i + 5) for i in range(100)])
    plan = bed.downsample(df, 100, False)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_weight" in line]
    assert windows and all("[_bucket" in line for line in windows)


def test_budget_of_the_published_run():
    # chr1 of the published downsampling: input, all input, target, output.
    budget = max(1, int(248_876_769 * 200_613_569 / 2_386_029_433))
    assert budget - 20_924_119 == 1_044


def test_interval_tables(spark):
    sets = bed.named_union({
        "A": bed_rows(spark, [("chr1", 0, 10), ("chr1", 5, 20), ("chrX", 0, 4), ("chrUn", 0, 9)]),
        "B": bed_rows(spark, [("chr2", 0, 200)]),
    })
    summary = {r.set_name: r for r in bed.interval_summary(sets).collect()}
    assert (summary["A"].intervals, summary["A"].total_bp, summary["A"].mean_width, summary["A"].median_width) == (3, 29, 9, 10)
    assert summary["A"].total_bp_text == "29 bp" and summary["B"].percent_grch38 == pytest.approx(200 / 30882698.32)
    coverage = {(r.set_name, r.contig): r.total_bp for r in bed.chromosome_coverage(sets).collect()}
    assert len(coverage) == 48 and coverage["A", "chr1"] == 25 and coverage["B", "chrY"] == 0
    assert [r.set_name for r in bed.width_distribution(sets).collect()] == ["A", "B"]
    row = bed.dominance(bed.set_totals(sets)).first()
    assert (row.largest, row.second, row.downsample) == ("B", "A", True)
    zero = spark.createDataFrame([("A", 5), ("B", 0)], "set_name string, total_bp bigint")
    assert bed.dominance(zero).first().ratio == float("inf") and bed.dominance(zero.limit(1)).count() == 0
    with pytest.raises(ValueError, match="unknown"):
        bed.match_target(zero, "mode")


def test_breakdown_keeps_one_sided_contigs(spark):
    before = bed_rows(spark, [("chr10", 0, 10), ("chr2", 0, 10), ("chr2", 0, 5)])
    after = bed_rows(spark, [("chr2", 0, 5), ("chrX", 0, 1)])
    parts = bed.breakdown(before, after)
    assert [tuple(r)[:5] for r in parts.collect()] == [
        ("chr2", 2, 15, 1, 5), ("chr10", 1, 10, None, None), ("chrX", None, None, 1, 1)]
    totals = bed.breakdown_totals(parts).first()
    assert (totals.input_bp, totals.output_bp, totals.reduction_percent) == (25, 6, pytest.approx(76.0))


def test_welch_and_d_of_tiny_groups(spark):
    """One value has no variance: no error, and NULL where nothing is known."""
    names = [m for m in pairwise.metrics.METRICS]
    row = lambda s, g, v: (s, "eur", g, "S", *[float(v)] * len(names))
    df = spark.createDataFrame([row("a", "A", 1), row("b", "B", 2), row("c", "C", 5), row("d", "C", 7), row("e", "C", 9)],
                               "sample_id string, ancestry string, grp string, set_name string, " + ", ".join(f"{n} double" for n in names))
    got = {(r.group_x, r.group_y): (r.cohens_d, r.p_value) for r in pairwise.compare_groups(df, min_samples=1, min_values=1).collect()}
    assert got[("A", "B")] == (None, None) and got[("A", "C")][1] is None and got[("A", "C")][0] < 0
    with pytest.raises(ValueError, match="min_values"):
        pairwise.compare_groups(df, min_values=0)


def test_cross_ancestry_with_pairs_the_other_way_round(spark):
    rows = [("eur", "A", "B", "S_snp_total", 0.4, 0.01), ("afr", "B", "A", "S_snp_total", -0.3, 0.01)]
    df = spark.createDataFrame(rows, "ancestry string, group_x string, group_y string, metric string, cohens_d double, p_value double").withColumn("neg_log10_p", F.lit(2.0))
    got = report.cross_ancestry(report.parsed(df), "eur", "afr").collect()
    assert [(r.group_pair, r.d_x, r.d_y) for r in got] == [("A vs B", 0.4, 0.3)]
    assert report.stored_pairs(report.parsed(df)) == ["A vs B", "B vs A"]


def test_carrier_bitmaps_count_like_calls(spark):
    """Every bit of a word, folds of more than one part, a site without calls, null calls, masked and haploid calls."""
    rng = random.Random(12)
    names = [f"n{i:03d}" for i in range(300)]
    kinds = [(0, 1), (1, 1), (1, None), (None, None), (0, 0)]
    site_rows, truth = [], {}
    for pos in range(40):
        cls, sets, share = rng.choice(["ti", "tv", "ins", "del", "other"]), rng.sample(["A", "B"], rng.randint(1, 2)), rng.random()
        calls = [(i, names[i], *rng.choice(kinds), rng.choice([None, "PASS", "LowGQ"])) for i in range(300) if rng.random() < share]
        site_rows += [(s, cls, None if pos == 7 else [] if pos == 8 else calls) for s in sets]
        for s in sets if pos not in (7, 8) else []:
            for _, name, a1, a2, ft in calls:
                zyg = "het" if (a1, a2) == (0, 1) else "hom" if a1 == 1 else None
                if zyg and ft != "LowGQ":
                    truth[name, s, cls, zyg] = truth.get((name, s, cls, zyg), 0) + 1
    schema = "set_name string, allele_class string, calls array<struct<sample_no: int, sample_id: string, a1: int, a2: int, ft: string>>"
    sites = spark.createDataFrame(site_rows, schema).repartition(3)
    header = spark.createDataFrame(list(enumerate(names)), "sample_no int, sample_id string")
    packed = bitmaps.pack_carriers(sites, haploid_as_hom=True)
    found = {(r.sample_id, r.set_name): r for r in bitmaps.packed_counts(packed, header, ["A", "B", "C"]).collect()}
    assert len(found) == 900
    for (name, s), row in found.items():
        for counter, (cls, zyg) in counting.COUNTED.items():
            assert row[counter] == truth.get((name, s, cls, zyg), 0)

    wanted = header.filter("sample_no % 3 = 0").select("sample_id")
    some = bitmaps.packed_counts(packed, header, ["A", "B"], wanted_words(header, wanted)).collect()
    for row in some:
        if int(row.sample_id[1:]) % 3:
            assert not any(row[c] for c in counting.COUNTED)
        else:
            assert row == found[row.sample_id, row.set_name]


def test_carrier_bitmaps_make_no_row_per_call(spark):
    schema = "set_name string, allele_class string, calls array<struct<sample_no: int, sample_id: string, a1: int, a2: int, ft: string>>"
    common = spark.createDataFrame([("A", "ti", [(i, f"n{i}", 0, 1, None) for i in range(640)])], schema)
    words = bitmaps.pack_carriers(common).first().words
    assert [w.word for w in words] == list(range(10)) and all(w.het == -1 and w.hom == 0 for w in words)
