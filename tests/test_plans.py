import random
from types import SimpleNamespace

import pytest

from cohortspark import CohortSettings, build_report, downsample_file, probe_sets, run_cohort
from cohortspark.plans import downsample_context
from cohortspark.shared import cut_lineage, shared_root
from cohortspark.sinks import sampled_rows, write_bed


def write(path, lines):
    path.write_text("".join(line + "\n" for line in lines))
    return str(path)


@pytest.fixture(scope="module")
def cohort(tmp_path_factory):
    """48 samples in two ancestries and two groups, a VCF, and two interval files."""
    folder = tmp_path_factory.mktemp("cohort")
    rng = random.Random(4)
    samples = [f"{i:03d}" for i in range(48)]
    header = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples])
    lines = ["##fileformat=VCFv4.2", header]
    truth = []
    for pos in range(1, 401):
        ref, alt = rng.choice([("A", "G"), ("A", "C"), ("A", "AT"), ("AT", "A"), ("C", "T,G")])
        flt = rng.choice(["PASS", ".", "LowQual"])
        gts = [rng.choice(["0/0", "0/1", "1/1", "./."] + (["1/2"] if "," in alt else [])) for _ in samples]
        fts = [rng.choice(["PASS", ".", "LowGQ"]) for _ in samples]
        cells = [f"{g}:{f}" for g, f in zip(gts, fts)]
        lines.append("\t".join(["chr1", str(pos), ".", ref, alt, "9", flt, "AC=1", "GT:FT", *cells]))
        truth.append((pos, ref, alt, flt, gts, fts))
    return {
        "folder": folder, "samples": samples, "truth": truth,
        "vcf": write(folder / "calls.vcf", lines),
        "anc": write(folder / "anc.tsv", ["research_id\tpop", *[f"{s}\t{'eur' if i % 2 else 'afr'}" for i, s in enumerate(samples)]]),
        "grp": write(folder / "grp.tsv", ["research_id\tsite", *[f"{s}\t{'X' if i % 4 < 2 else 'Y'}" for i, s in enumerate(samples[:-1])]]),
        "sets": {
            "Low_Map": write(folder / "low.bed", ["# x", "chr1\t0\t200", "chr1\t100\t300"]),
            "GC_gt_85": write(folder / "gc.interval_list", ["@HD", "chr1\t250\t350\t+\tn"]),
        },
    }


def settings(cohort, **more):
    return CohortSettings(
        cohort["vcf"], cohort["anc"], cohort["grp"], "site", cohort["sets"], comparison_name="sequencing_site",
        ancestry_col="pop", min_samples_per_group=5, min_values=5, **more,
    )


def brute_counts(cohort, sample, lo, hi):
    i, n = cohort["samples"].index(sample), {}
    kinds = {("A", "G"): "snp_ti", ("A", "C"): "snp_tv", ("A", "AT"): "indel_ins", ("AT", "A"): "indel_del",
             ("C", "T"): "snp_ti", ("C", "G"): "snp_tv"}
    for pos, ref, alts, flt, gts, fts in cohort["truth"]:
        if not lo <= pos <= hi or flt == "LowQual" or fts[i] == "LowGQ" or gts[i] == "./.":
            continue
        for k, alt in enumerate(alts.split(","), 1):
            pair = [int(a) == k for a in gts[i].split("/")]
            if any(pair):
                key = f"{kinds[ref, alt]}_{'hom' if all(pair) else 'het'}"
                n[key] = n.get(key, 0) + 1
    return n


def test_run_and_report(spark, cohort, tmp_path):
    out, cache = str(tmp_path / "out"), str(tmp_path / "cache")
    results = run_cohort(spark, settings(cohort, output_dir=out, cache_path=cache))
    stats = {r.sample_id: r for r in results.sample_stats.collect()}
    assert set(stats) == set(cohort["samples"][:-1])  # the last sample has no group label
    for sample in ("000", "007", "040"):
        for name, (lo, hi) in {"Low_Map": (1, 300), "GC_gt_85": (250, 350)}.items():
            want = brute_counts(cohort, sample, lo, hi)
            row = stats[sample].asDict()
            got = {k: row[f"{name}_{k}"] for k in want}
            assert got == want
            assert row[f"{name}_snp_total"] == sum(v for k, v in want.items() if k.startswith("snp"))
    assert results.comparisons.count() == 2 * 2 * 4  # ancestries x sets x metrics
    assert set(results.written) == {"sample_stats", "group_summaries", "comparisons"}

    drawn = run_cohort(spark, settings(cohort, output_dir=str(tmp_path / "drawn"), export_sampled_per_sample=True, sampled_per_sample_n=9))
    assert spark.read.csv(drawn.written["sampled_stats"], sep="\t", header=True).count() == 9
    assert spark.read.csv(drawn.written["sample_stats"], sep="\t", header=True).count() == 47

    bitmaps = run_cohort(spark, settings(cohort, cache_path=cache, count_by_bitmaps=True))
    assert {r.sample_id: r for r in bitmaps.sample_stats.collect()} == stats

    again = run_cohort(spark, settings(cohort, cache_path=cache))
    assert again.written == {}
    cached = run_cohort(spark, CohortSettings(
        cache, cohort["anc"], cohort["grp"], "site", cohort["sets"], ancestry_col="pop", min_samples_per_group=5, min_values=5))
    key = ["ancestry", "metric", "cohens_d"]
    assert sorted(map(tuple, cached.comparisons.select(*key).collect())) == sorted(
        map(tuple, results.comparisons.select(*key).collect()))

    tables = build_report(spark, out, threshold=0.2)
    assert tables["flag_totals"].first().n_total == 16
    assert tables["heatmap"].count() == 16 and "X vs Y" in tables["heatmap"].columns
    assert tables["distributions"].count() == 2 * 2 * 2 * 4
    assert tables["pca"].count() == 47
    assert tables["cross_ancestry"].count() == 8
    assert {r.grp for r in tables["sample_sizes"].collect()} == {"X", "Y"}
    assert tables["group_means"].count() == 2 * 2 * 2 * 4
    lean = build_report(spark, out, load_sample_stats=False, comparison_name="sequencing_site", ancestry_x="eur", ancestry_y="afr")
    assert not {"distributions", "pca"} & set(lean) and {r.ancestry_x for r in lean["cross_ancestry"].collect()} == {"eur"}
    capped = build_report(spark, out, max_per_group=3, max_samples=11)
    assert max(r.n for r in capped["distributions"].collect()) == 3 and capped["pca"].count() == 22
    assert tables["volcano"].count() == 16 and tables["flagged"].count() == tables["flag_totals"].first().n_flagged


def test_run_settings(spark, cohort, tmp_path):
    some = run_cohort(spark, settings(cohort, samples_per_group=6, ancestries=["eur"], filter_to_pass=False, filter_ft_pass=False))
    assert some.sample_stats.count() == 12
    loose = {r.sample_id: r.Low_Map_snp_total for r in some.sample_stats.collect()}
    strict = {r.sample_id: r.Low_Map_snp_total for r in run_cohort(spark, settings(cohort)).sample_stats.collect()}
    assert all(loose[s] > strict[s] for s in loose)
    with pytest.raises(ValueError, match="No groups"):
        run_cohort(spark, settings(cohort, samples_per_group=30, ancestries=["nowhere"]))
    with pytest.raises(ValueError, match="min_values"):
        CohortSettings(cohort["vcf"], cohort["anc"], cohort["grp"], "site", cohort["sets"], min_values=0)
    with pytest.raises(ValueError, match="interval"):
        CohortSettings(cohort["vcf"], cohort["anc"], cohort["grp"], "site")


def test_skipped_set_leaves_no_columns(spark, cohort):
    more = settings(cohort, on_missing_set="skip")
    more.interval_paths = {**cohort["sets"], "Gone": "/nowhere.bed"}
    columns = run_cohort(spark, more).sample_stats.columns
    assert not any(c.startswith("Gone") for c in columns) and "Low_Map_snp_total" in columns


def test_disjoint_pieces_sum_to_the_whole(spark, cohort, tmp_path):
    halves = {"left": write(tmp_path / "l.bed", ["chr1\t0\t120"]), "right": write(tmp_path / "r.bed", ["chr1\t120\t300"])}
    pieces = settings(cohort)
    pieces.interval_paths = {**halves, **cohort["sets"]}
    for r in run_cohort(spark, pieces).sample_stats.collect():
        assert r.left_snp_total + r.right_snp_total == r.Low_Map_snp_total


def test_exports(spark, tmp_path):
    df = spark.range(50).selectExpr("CAST(id AS STRING) AS sample_id", "id AS v")
    drawn = sampled_rows(df, 7, 42)
    assert drawn.count() == 7
    assert sorted(r.v for r in drawn.collect()) == sorted(r.v for r in sampled_rows(df.repartition(9), 7, 42).collect())
    assert sampled_rows(df, 100).count() == 50


def test_interval_tools(spark, tmp_path):
    rng = random.Random(8)
    big = write(tmp_path / "big.bed", [f"chr{rng.randint(1, 3)}\t{i * 100}\t{i * 100 + rng.randint(1, 90)}" for i in range(500)])
    small = write(tmp_path / "small.bed", [f"chr1\t{i}\t{i + 9}" for i in range(100)])
    probe = probe_sets(spark, {"big": big, "small": small})
    assert probe.summary.count() == 2 and probe.dominance.first().downsample and probe.chromosomes.count() == 48
    after, parts, totals = downsample_file(spark, big, str(tmp_path / "out"), match_files=[small], stat="max")
    t = totals.first()
    assert 0 < t.output_bp <= 900 and t.output_intervals == after.count() and parts.count() == 3
    how = spark.read.json(str(tmp_path / "out.manifest")).first()
    assert how.params.seed == 42 and how.params.stratified and how.target.bp == 900 and "max of" in how.target.source
    assert (how.input.intervals, how.output.intervals, how.output.total_bp) == (500, t.output_intervals, t.output_bp)
    assert [c.contig for c in how.per_contig] == [r.contig for r in parts.collect()] and sum(c.input_bp for c in how.per_contig) == t.input_bp
    context = downsample_context(spark, big, after)
    sizes = {r.set_name: r.intervals for r in context.summary.collect()}
    assert sizes == {"big": 500, "small": 100, "big (downsampled)": t.output_intervals}
    assert {r.set_name for r in downsample_context(spark, big, after, {}).summary.collect()} == {"big", "big (downsampled)"}
    written = spark.read.text(str(tmp_path / "out"))
    assert written.count() == t.output_intervals
    order = [(r.chrom_order, r.start0) for r in after.collect()]
    assert order == sorted(order)
    unchanged, _, t = downsample_file(spark, big, target_bp=10**9, stratify=False)
    assert unchanged.count() == 500 and t.first().reduction_percent == 0
    write_bed(unchanged, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    with pytest.raises(ValueError, match="target_bp"):
        downsample_file(spark, big)


def test_lineage_is_cut_in_the_shared_folder(spark):
    df = cut_lineage(spark.range(10).selectExpr("id * 2 AS x", "id AS y"))
    assert df.count() == 10 and all(shared_root(spark) in f for f in df.inputFiles())
    plan = df.select("y")._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "ReadSchema: struct<y:bigint>" in plan


def stand_in(configured=None, current=None, master="yarn"):
    """What ``shared_root`` reads of a session."""
    context = SimpleNamespace(getCheckpointDir=lambda: current, master=master, applicationId="x")
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured))


def test_shared_folder_comes_from_the_session():
    assert shared_root(stand_in("hdfs:///shared/", "/other")) == "hdfs:///shared"
    assert shared_root(stand_in(None, "hdfs:///set-by-context")) == "hdfs:///set-by-context"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(stand_in())
