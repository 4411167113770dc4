"""One query per operator over the given tables; names and columns match ``checks.oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.functions import metrics
from cohortspark.operators import bed, calls as call_ops, counting, labels, membership, pairwise, pca, report
from cohortspark.plans.cohort import count_callset
from cohortspark.shared import cut_lineage, shared_path
from cohortspark.plans.intervals import provenance, write_manifest
from cohortspark.plans.report import build_report
from cohortspark.sinks import sampled_rows, write_bed, write_results, write_tsv
from cohortspark.sources import callset as callset_source
from cohortspark.sources import intervals as interval_source
from cohortspark.sources import labels as label_source
from cohortspark.sources import results as result_source

from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round the floating columns, so that both engines print the same value."""
    return df.select(
        *[
            F.round(F.col(f"`{c}`"), special.get(c, digits)).alias(c) if t == "double" else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )


# --- labels -------------------------------------------------------------------------------


@query
def q_labels_merge(spark, sf_dir):
    merged = labels.merge_labels(
        fx.ancestry(spark, sf_dir), fx.groups(spark, sf_dir), ["AFRICA", "ASIA", "EUROPE"], fx.GROUPS[:4]
    )
    return labels.label_counts(merged)


@query
def q_distinct_labels(spark, sf_dir):
    return labels.distinct_labels(fx.samples(spark, sf_dir))


@query
def q_unmatched_labels(spark, sf_dir):
    """Ids of two tables that overlap in part."""
    orders = fx.table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey * 3 AS STRING) AS sample_id")
    parts = fx.table(spark, sf_dir, "part").selectExpr("CAST(p_partkey AS STRING) AS sample_id")
    return labels.unmatched_counts(orders, parts)


@query
def q_subsample(spark, sf_dir):
    return labels.subsample(fx.samples(spark, sf_dir), samples_per_group=50, min_samples_per_group=50, seed=fx.SEED)


# --- sites and calls ----------------------------------------------------------------------


@query
def q_site_filter(spark, sf_dir):
    kept = call_ops.passing_calls(call_ops.passing_sites(fx.calls(spark, sf_dir)))
    rows = call_ops.with_zygosity(call_ops.classify(kept))
    return rows.groupBy("contig", "allele_class", "zygosity").agg(F.count(F.lit(1)).alias("n"))


@query
def q_freq_filter(spark, sf_dir):
    kept = call_ops.frequent_sites(fx.sites(spark, sf_dir), 0.01, 100)
    return kept.select("contig", "pos", F.array_join("alts", ",").alias("alts"))


@query
def q_split_multi(spark, sf_dir):
    split = call_ops.split_alleles(fx.sites(spark, sf_dir))
    return rounded(split.select("contig", "pos", "ref", "alt", F.array_max("af").alias("max_af"),
                                F.array_max("ac").cast("bigint").alias("max_ac")))


@query
def q_membership(spark, sf_dir):
    return membership.membership(fx.calls(spark, sf_dir), fx.site_sets(spark, sf_dir), block_bp=fx.BLOCK_BP)


@query
def q_membership_shuffled(spark, sf_dir):
    """The same join on its other way: index too large to broadcast, hot blocks cut into parts."""
    points = fx.calls(spark, sf_dir).select("sample_id", "contig", "pos")
    placed = membership.attach_sets(
        points, fx.site_sets(spark, sf_dir), block_bp=fx.BLOCK_BP, broadcast_entries=0, min_hot_rows=100, large="blocks"
    )
    return placed.groupBy("contig", "pos", "set_name").agg(F.count(F.lit(1)).alias("n_calls"))


@query
def q_membership_sweep(spark, sf_dir):
    """The sweep: every interval is two steps, one of them over a whole contig; cells of 128 bp carry what is open."""
    sets = fx.site_sets(spark, sf_dir).union(spark.sql("SELECT 'WHOLE', 'chr7', 0, 100000000"))
    return membership.sweep_membership(fx.calls(spark, sf_dir), sets, cell_bp=128)


@query
def q_interval_files_skipped(spark, sf_dir):
    """One good set, one with a broken line and one that is not there: each file is read once."""
    folder = shared_path(spark, "intervals")
    part = fx.table(spark, sf_dir, "part")
    part.selectExpr("concat_ws('\\t', 'chr1', p_partkey, p_partkey + p_size) AS value").write.text(f"{folder}/good.bed")
    part.selectExpr("concat_ws('\\t', 'chr1', p_partkey, CASE WHEN p_partkey % 100 = 7 THEN 'x' ELSE CAST(p_partkey + 1 AS STRING) END) AS value").write.text(f"{folder}/bad.bed")
    paths = {"good": f"{folder}/good.bed", "bad": f"{folder}/bad.bed", "gone": f"{folder}/gone.bed"}
    return interval_source.read_site_sets(spark, paths, "skip").selectExpr("set_name", "contig", "CAST(start AS BIGINT) AS a", "CAST(end AS BIGINT) AS b")


# --- counts and metrics -------------------------------------------------------------------


def sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = call_ops.carriers(call_ops.passing_sites(fx.calls(spark, sf_dir)))
    rows = call_ops.with_zygosity(call_ops.classify(call_ops.keep_samples(kept, fx.samples(spark, sf_dir))))
    carriers = membership.attach_sets(
        rows.select("sample_id", "contig", "pos", "allele_class", "zygosity"),
        fx.site_sets(spark, sf_dir), block_bp=fx.BLOCK_BP,
    )
    # Every sample of the callset, with or without a call that counts; every order has calls.
    header = fx.table(spark, sf_dir, "orders").selectExpr("CAST(o_custkey AS STRING) AS sample_id").distinct()
    return counting.sample_counts(carriers, header, fx.SETS)


def sample_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = counting.add_labels(sample_counts(spark, sf_dir), fx.samples(spark, sf_dir))
    return counting.derived_metrics(counts)


def comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise.compare_groups(
        sample_metrics(spark, sf_dir), "segment", min_samples=fx.MIN_SAMPLES, min_values=fx.MIN_VALUES
    )


def kept_comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparisons materialised: the report tables read them more than once."""
    return cut_lineage(comparisons(spark, sf_dir))


@query
def q_sample_counts(spark, sf_dir):
    return sample_counts(spark, sf_dir)


@query
def q_sample_wide(spark, sf_dir):
    return counting.widen(sample_counts(spark, sf_dir), fx.SETS, metrics.COUNTERS)


@query
def q_derived(spark, sf_dir):
    return rounded(sample_metrics(spark, sf_dir).select("sample_id", "set_name", *metrics.DERIVED))


@query
def q_group_summaries(spark, sf_dir):
    return rounded(counting.group_summaries(sample_metrics(spark, sf_dir)))


@query
def q_group_summaries_wide(spark, sf_dir):
    return rounded(counting.group_summaries_wide(sample_metrics(spark, sf_dir), fx.SETS))


# --- comparisons --------------------------------------------------------------------------


@query
def q_pairwise_d(spark, sf_dir):
    return rounded(comparisons(spark, sf_dir).drop("p_value", "neg_log10_p", "set_name", "metric_type"))


@query
def q_pairwise_d_pooled(spark, sf_dir):
    rows = pairwise.compare_groups(
        sample_metrics(spark, sf_dir), "segment", fx.MIN_SAMPLES, fx.MIN_VALUES, ddof=1, group_order=fx.GROUPS[::-1]
    )
    return rounded(rows.select("ancestry", "group_x", "group_y", "metric", "std_x", "std_y", "cohens_d"))


@query
def q_pairwise_p(spark, sf_dir):
    rows = comparisons(spark, sf_dir).select("ancestry", "group_x", "group_y", "metric", "p_value", "neg_log10_p")
    shown = rows.withColumn("neg_log10_p", F.when(F.col("p_value") > 1e-6, F.col("neg_log10_p")))
    return rounded(shown, neg_log10_p=4)


@query
def q_pairwise_small(spark, sf_dir):
    """Groups of a few samples, down to one: no error, and NULL where a value is unknown."""
    fine = sample_metrics(spark, sf_dir).withColumn("ancestry", F.concat("ancestry", (F.col("sample_id").cast("bigint") % 40).cast("string")))
    rows = pairwise.compare_groups(fine, "segment", min_samples=1, min_values=1)
    return rounded(rows.select(
        "ancestry", "group_x", "group_y", "metric", "n_x", "n_y", "cohens_d", F.col("p_value").isNotNull().alias("has_p")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels, sets, counts, metrics and comparisons in one plan, all samples in one stratum."""
    one = sample_metrics(spark, sf_dir).withColumn("ancestry", F.lit("all"))
    rows = pairwise.compare_groups(one, "segment", min_samples=fx.MIN_SAMPLES, min_values=fx.MIN_VALUES)
    return rounded(
        rows.select("ancestry", "group_x", "group_y", "metric", "n_x", "n_y", "mean_x", "mean_y", "cohens_d", "p_value")
    )


@query
def q_flagship(spark, sf_dir):
    return flagship(spark, sf_dir)


# --- report tables ------------------------------------------------------------------------

FLAG_COLUMNS = ["ancestry", "group_pair", "set_name", "metric_name", "cohens_d", "p_value", "severity"]


@query
def q_flagged(spark, sf_dir):
    return rounded(report.flagged(comparisons(spark, sf_dir)).select(*FLAG_COLUMNS))


@query
def q_flagged_top(spark, sf_dir):
    rows = rounded(report.flagged(comparisons(spark, sf_dir)), digits=9)
    return rounded(report.flagged_top(rows).select(*FLAG_COLUMNS))


@query
def q_flag_totals(spark, sf_dir):
    return report.flag_totals(comparisons(spark, sf_dir))


@query
def q_most_affected_sets(spark, sf_dir):
    return report.most_affected_sets(report.flagged(comparisons(spark, sf_dir)))


@query
def q_heatmap(spark, sf_dir):
    return rounded(report.heatmap(comparisons(spark, sf_dir), report.pair_names(fx.GROUPS)))


@query
def q_heatmap_p(spark, sf_dir):
    return rounded(report.heatmap(comparisons(spark, sf_dir), report.pair_names(fx.GROUPS), "p_value"))


@query
def q_heatmap_text(spark, sf_dir):
    cells = report.heatmap_cells(comparisons(spark, sf_dir))
    return cells.select("ancestry", "row_label", "group_pair", "cell_text")


@query
def q_volcano(spark, sf_dir):
    rows = report.volcano(kept_comparisons(spark, sf_dir))
    shown = rows.withColumn("neg_log10_p", F.when(F.col("neg_log10_p") < 6, F.col("neg_log10_p")))
    return rounded(shown, neg_log10_p=4)


@query
def q_cross_stratum(spark, sf_dir):
    return rounded(report.cross_ancestry(kept_comparisons(spark, sf_dir)))


@query
def q_cross_corr(spark, sf_dir):
    matched = report.cross_ancestry(kept_comparisons(spark, sf_dir), "ASIA", "EUROPE")
    return rounded(report.cross_correlation(matched))


@query
def q_group_means(spark, sf_dir):
    """Groups are nations here, each in one region only, so most cells do not occur and are filled."""
    counts = counting.add_labels(sample_counts(spark, sf_dir), fx.nation_samples(spark, sf_dir))
    return rounded(report.group_means(cut_lineage(counting.group_summaries(counting.derived_metrics(counts)))))


@query
def q_distributions(spark, sf_dir):
    return rounded(report.distributions(report.long_metrics(sample_metrics(spark, sf_dir))))


@query
def q_distributions_drawn(spark, sf_dir):
    rows = cut_lineage(report.long_metrics(sample_metrics(spark, sf_dir)))
    return rounded(report.distributions(rows, max_per_group=40, seed=fx.SEED))


@query
def q_sample_sizes(spark, sf_dir):
    return report.sample_size_table(comparisons(spark, sf_dir), fx.ANCESTRIES)


@query
def q_metric_parse(spark, sf_dir):
    """Metric names of every part: published-looking names, unknown ones and bare suffixes."""
    name = (
        "CASE p_partkey % 5 WHEN 0 THEN concat('GC_gt_', CAST(p_size AS STRING), '_indel_total') "
        "WHEN 1 THEN concat(p_type, '_snp_ti_het') WHEN 2 THEN '_snp_total' "
        "WHEN 3 THEN concat('foo', CAST(p_size AS STRING)) ELSE concat(p_type, '_snp_het') END"
    )
    rows = fx.table(spark, sf_dir, "part").selectExpr("p_partkey", f"{name} AS name")
    return rows.select(
        "p_partkey", "name", metrics.parse_metric(F.col("name")).alias("m")
    ).select("p_partkey", "name", "m.set_name", "m.metric_type",
             metrics.display_metric(F.col("m.metric_type")).alias("metric_name"))


@query
def q_metric_pca(spark, sf_dir):
    wide = cut_lineage(counting.widen(sample_metrics(spark, sf_dir), fx.SETS))
    features = [c for c in wide.columns if c not in ("sample_id", "ancestry", "grp")]
    return rounded(pca.metric_pca(wide, features, "ancestry", ["sample_id", "grp"]), 4)


@query
def q_embedding_pca(spark, sf_dir):
    vectors = fx.table(spark, sf_dir, "embeddings")
    names = [f"e{i}" for i in range(64)]
    wide = vectors.select("vec_id", "label", *[F.get("embedding", F.lit(i)).alias(n) for i, n in enumerate(names)])
    return rounded(pca.metric_pca(cut_lineage(wide), names, "label", ["vec_id"]), 4)


@query
def q_pca_moments(spark, sf_dir):
    """What the components are computed from: count, means and correlations per stratum."""
    rows = sample_metrics(spark, sf_dir)
    vectors = rows.select("ancestry", F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in fx.PCA_METRICS]).alias("_x"))
    width = len(fx.PCA_METRICS)
    found = cut_lineage(pca.stratum_moments(vectors, "ancestry", width))
    at = lambda i, j: F.get("comoment", F.col(i) * width + F.col(j))
    pairs = found.select("*", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("i")).select(
        "*", F.explode(F.sequence(F.col("i"), F.lit(width - 1))).alias("j"))
    return rounded(pairs.select(
        F.col("stratum").alias("ancestry"), "i", "j", "n", F.get("mean", F.col("i")).alias("mean_i"),
        (at("i", "j") / F.sqrt(at("i", "i") * at("j", "j"))).alias("r")))


# --- interval tools -----------------------------------------------------------------------


@query
def q_interval_summary(spark, sf_dir):
    return rounded(bed.interval_summary(fx.bed_sets(spark, sf_dir)))


@query
def q_chrom_coverage(spark, sf_dir):
    return bed.chromosome_coverage(fx.bed_sets(spark, sf_dir))


@query
def q_width_dist(spark, sf_dir):
    return rounded(bed.width_distribution(fx.bed_sets(spark, sf_dir)))


@query
def q_match_target(spark, sf_dir):
    totals = bed.set_totals(fx.bed_sets(spark, sf_dir))
    targets = [bed.match_target(totals, stat).select(F.lit(stat).alias("stat"), "target_bp")
               for stat in ("max", "min", "median", "mean")]
    return membership.union_sets(targets)


@query
def q_dominance(spark, sf_dir):
    """Set totals against each other, and a union of all sets against the smallest."""
    sets = fx.bed_sets(spark, sf_dir)
    plain = bed.dominance(bed.set_totals(sets)).withColumn("case", F.lit("sets"))
    merged = sets.withColumn("set_name", F.when(F.col("set_name") == "SMALL", "SMALL").otherwise("REST"))
    return rounded(plain.unionByName(bed.dominance(bed.set_totals(merged)).withColumn("case", F.lit("rest"))))


BED_KEY = ["contig", "start0", "end0", "set_name"]


def _target(sets: DataFrame) -> F.Column:
    """The smallest set's base pairs, as a scalar subquery."""
    return bed.match_target(bed.set_totals(sets), "min").scalar()


@query
def q_downsample_strat(spark, sf_dir):
    sets = fx.bed_sets(spark, sf_dir)
    return bed.karyotype_order(bed.downsample(sets, _target(sets), True, fx.SEED, BED_KEY))


@query
def q_downsample_uniform(spark, sf_dir):
    sets = fx.bed_sets(spark, sf_dir)
    return bed.downsample(sets, _target(sets), False, fx.SEED, BED_KEY)


@query
def q_downsample_tight(spark, sf_dir):
    """A budget that fits nothing on some contigs: the narrowest interval stands in."""
    sets = fx.bed_sets(spark, sf_dir)
    return bed.downsample(sets, 300, True, fx.SEED, BED_KEY)


@query
def q_bed_roundtrip(spark, sf_dir):
    """A drawn set written as BED and read back."""
    sets = fx.bed_sets(spark, sf_dir)
    path = f"{shared_path(spark, 'bed')}/drawn.bed"
    write_bed(bed.downsample(sets, _target(sets), True, fx.SEED, BED_KEY), path)
    return interval_source.read_bed(spark, path).select("contig", "start0", "end0")


@query
def q_downsample_breakdown(spark, sf_dir):
    sets = fx.bed_sets(spark, sf_dir)
    return bed.breakdown(sets, bed.downsample(sets, _target(sets), False, fx.SEED, BED_KEY))


@query
def q_downsample_manifest(spark, sf_dir):
    """The breakdown and settings of a draw, written beside its output and read back."""
    sets = fx.bed_sets(spark, sf_dir)
    parts = bed.breakdown(sets, bed.downsample(sets, _target(sets), False, fx.SEED, BED_KEY))
    written = write_manifest(provenance(parts, "in.bed", "out.bed", F.lit(1_500).cast("bigint"), "given", False, fx.SEED), f"{shared_path(spark, 'bed')}/out.bed")
    row = spark.read.json(written)
    return row.select(F.inline("per_contig"), F.col("params.seed").alias("seed"), F.col("target.bp_text").alias("bp_text")).select(
        "contig", "seed", "bp_text", "input_intervals", "input_bp", "output_intervals", "output_bp")


@query
def q_downsample_totals(spark, sf_dir):
    sets = fx.bed_sets(spark, sf_dir)
    return rounded(bed.breakdown_totals(bed.breakdown(sets, bed.downsample(sets, _target(sets), True, fx.SEED, BED_KEY))))


# --- files --------------------------------------------------------------------------------


@query
def q_sampled_export(spark, sf_dir):
    wide = counting.widen(sample_counts(spark, sf_dir), fx.SETS, ["snp_ti_het", "indel_del_hom"])
    return sampled_rows(wide, 400, fx.SEED)


@query
def q_tsv_labels(spark, sf_dir):
    """Label files with zero-padded ids, extra columns and empty labels, written and read back."""
    folder = shared_path(spark, "labels")
    customer = fx.table(spark, sf_dir, "customer")
    padded = "lpad(CAST(c_custkey AS STRING), 9, '0') AS research_id"
    write_tsv(customer.selectExpr(padded, "c_name", "CAST(c_nationkey AS STRING) AS ancestry_pred_other"), f"{folder}/a.tsv")
    # Customers without orders have no group; some labels are missing, written in several ways.
    buyers = fx.table(spark, sf_dir, "orders").selectExpr("o_custkey AS c_custkey").distinct()
    site = "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'NA' WHEN c_custkey % 17 = 0 THEN 'null' " \
           "ELSE concat('site', CAST(c_custkey % 5 AS STRING)) END AS site_id"
    write_tsv(buyers.selectExpr(padded, site, "'x' AS note"), f"{folder}/g.tsv")
    return labels.merge_labels(
        label_source.read_ancestry(spark, f"{folder}/a.tsv"),
        label_source.read_groups(spark, f"{folder}/g.tsv", "site_id"),
    )


@query
def q_interval_files(spark, sf_dir):
    """Interval text with comments, extra columns, empty and reversed intervals and odd contigs, three readers."""
    folder = shared_path(spark, "intervals")
    part = fx.table(spark, sf_dir, "part")
    contig = "CASE WHEN p_partkey % 17 = 0 THEN 'chrUn_x' WHEN p_partkey % 19 = 0 THEN 'chrX' " \
             "ELSE concat('chr', CAST(1 + p_size % 22 AS STRING)) END"
    end = "CASE WHEN p_size % 10 = 0 THEN p_partkey - p_size % 20 ELSE p_partkey + p_size END"
    body = f"concat_ws('\\t', {contig}, p_partkey, {end}, p_name)"
    lines = part.selectExpr(f"explode(CASE WHEN p_partkey % 50 = 0 THEN array('# note', {body}) ELSE array({body}) END) AS value")
    lines.write.text(f"{folder}/set.bed")
    listed = part.selectExpr(
        f"explode(CASE WHEN p_partkey % 50 = 0 THEN array('@SQ', {body}) ELSE array({body}) END) AS value")
    listed.write.option("compression", "gzip").text(f"{folder}/set.interval_list")
    paths = interval_source.discover_beds(spark, folder)
    tool = interval_source.read_bed_sets(spark, paths).selectExpr("'tool' AS reader", "contig", "start0 AS a", "end0 AS b")
    sites = interval_source.read_site_sets(
        spark, {"bed": f"{folder}/set.bed", "list": f"{folder}/set.interval_list", "gone": f"{folder}/no.bed"}, "skip"
    ).selectExpr("set_name AS reader", "contig", "start AS a", "end AS b")
    return tool.unionByName(sites).selectExpr("reader", "contig", "CAST(a AS BIGINT) AS a", "CAST(b AS BIGINT) AS b")


def vcf_import(spark: SparkSession, sf_dir: str, **options):
    """VCF text derived from part and nation, imported through the cache."""
    return callset_source.cached_import(spark, fx.write_vcf(spark, sf_dir), shared_path(spark, "callset"), **options)


@query
def q_vcf_sites(spark, sf_dir):
    sites = vcf_import(spark, sf_dir).sites
    return rounded(sites.select(
        "contig", F.col("pos").cast("bigint").alias("pos"), "ref", "alt", F.array_join("filters", ";").alias("filters"),
        F.array_max("af").alias("max_af"), F.array_max("ac").cast("bigint").alias("max_ac"),
    ))


@query
def q_vcf_zones(spark, sf_dir):
    """The zone map of a callset stored in order of position, summed up over its files."""
    folder = shared_path(spark, "callset")
    stored = callset_source.cached_import(spark, fx.write_vcf(spark, sf_dir), folder, range_partitions=16)
    zones = spark.read.parquet(f"{stored.folder}/zones")
    return zones.groupBy("contig").agg(
        F.min("lo").cast("bigint").alias("lo"), F.max("hi").cast("bigint").alias("hi"), F.sum("sites").alias("sites"), F.sum("calls").alias("calls"))


@query
def q_vcf_cache_options(spark, sf_dir):
    """One cache path asked for two imports: each gets what its own options give."""
    path, cache = fx.write_vcf(spark, sf_dir), shared_path(spark, "callset")
    imports = [
        callset_source.cached_import(spark, path, cache, frequency_filter=f).sites.select(F.lit(name).alias("import"), "contig", F.col("pos").cast("bigint").alias("pos"), "ref", "alt")
        for name, f in (("all", False), ("frequent", True))
    ]
    return imports[0].unionByName(imports[1])


@query
def q_vcf_calls(spark, sf_dir):
    sites = vcf_import(spark, sf_dir, frequency_filter=True).sites
    carriers = call_ops.explode_carriers(sites.select("contig", "pos", "ref", "alt", "calls"), filter_ft=False)
    return carriers.selectExpr(
        "contig", "CAST(pos AS BIGINT) AS pos", "ref", "alt", "sample_id",
        "CAST(a1 AS BIGINT) AS a1", "CAST(a2 AS BIGINT) AS a2", "ft")


@query
def q_vcf_metrics(spark, sf_dir):
    """A callset from VCF text to labelled metrics per sample and set."""
    rows = count_callset(
        vcf_import(spark, sf_dir), fx.site_sets(spark, sf_dir), fx.SETS, fx.vcf_labels(spark, sf_dir), block_bp=fx.BLOCK_BP
    )
    return rounded(rows)


@query
def q_vcf_bgz(spark, sf_dir):
    """The sites again from one block-gzip file, read by ranges of 16 KB."""
    sites = callset_source.import_vcf(spark, fx.write_vcf_bgz(spark, sf_dir), range_bytes=1 << 14).sites
    return rounded(sites.select(
        "contig", F.col("pos").cast("bigint").alias("pos"), "ref", "alt", F.array_join("filters", ";").alias("filters"),
        F.array_max("af").alias("max_af"), F.array_max("ac").cast("bigint").alias("max_ac"),
    ))


@query
def q_vcf_customers(spark, sf_dir):
    """A VCF with a column per customer, of whom one segment is wanted: cells of the others are dropped before they are read."""
    wanted = fx.samples(spark, sf_dir).filter("grp = 'BUILDING'").selectExpr("CAST(sample_id AS STRING) AS sample_id", "ancestry", "grp")
    calls = callset_source.import_vcf(spark, fx.write_wide_vcf(spark, sf_dir), keep_samples=wanted)
    rows = count_callset(calls, fx.site_sets(spark, sf_dir), fx.SETS, wanted, block_bp=fx.BLOCK_BP)
    return rows.select("sample_id", "set_name", *metrics.COUNTERS)


@query
def q_vcf_metrics_bitmap(spark, sf_dir):
    """The metrics of the VCF again, counted by carrier bitmaps."""
    rows = count_callset(
        vcf_import(spark, sf_dir), fx.site_sets(spark, sf_dir), fx.SETS, fx.vcf_labels(spark, sf_dir), block_bp=fx.BLOCK_BP, by_bitmaps=True
    )
    return rounded(rows)


@query
def q_sample_counts_bitmap(spark, sf_dir):
    """A column per customer, counted 64 customers at a time, with one segment wanted."""
    wanted = fx.samples(spark, sf_dir).filter("grp = 'BUILDING'").selectExpr("CAST(sample_id AS STRING) AS sample_id", "ancestry", "grp")
    # Rows wait for the packing in Python, on disk where memory is short: small tasks hold few of them.
    calls = callset_source.import_vcf(spark, fx.write_wide_vcf(spark, sf_dir, packed=False))
    rows = count_callset(calls, fx.site_sets(spark, sf_dir), fx.SETS, wanted, block_bp=fx.BLOCK_BP, by_bitmaps=True)
    return rows.select("sample_id", "set_name", *metrics.COUNTERS)


def written_results(spark: SparkSession, sf_dir: str, group_order: list[str] | None = None) -> str:
    rows = cut_lineage(sample_metrics(spark, sf_dir))
    folder = shared_path(spark, "results")
    compared = pairwise.compare_groups(rows, "segment", fx.MIN_SAMPLES, fx.MIN_VALUES, group_order=group_order)
    write_results(
        folder, counting.widen(rows, fx.SETS), counting.group_summaries_wide(rows, fx.SETS),
        compared.select(*pairwise.COMPARISON_COLUMNS), "segment",
    )
    return folder


@query
def q_results_comparisons(spark, sf_dir):
    """Comparisons written as TSV and read back, metric names parsed from text."""
    data = result_source.read_results(spark, written_results(spark, sf_dir))
    return rounded(report.parsed(data.comparisons).select(
        "comparison", "ancestry", "group_pair", "set_name", "metric_type", "n_x", "n_y", "mean_x", "cohens_d"))


@query
def q_results_summaries(spark, sf_dir):
    data = result_source.read_results(spark, written_results(spark, sf_dir), load_sample_stats=False)
    return rounded(result_source.long_summaries(data.group_summaries, data.comparison_name))


@query
def q_results_distributions(spark, sf_dir):
    data = result_source.read_results(spark, written_results(spark, sf_dir))
    return rounded(report.distributions(result_source.long_sample_stats(data.sample_stats, data.comparison_name)))


@query
def q_report_distributions(spark, sf_dir):
    """The report of a run with default settings covers every sample."""
    return rounded(build_report(spark, written_results(spark, sf_dir))["distributions"])


@query
def q_heatmap_reversed(spark, sf_dir):
    """Pairs stored in another order than the alphabet's keep their columns; the cells of the matrix as rows."""
    matrix = build_report(spark, written_results(spark, sf_dir, fx.GROUPS[::-1]))["heatmap"]
    cells = [F.struct(F.lit(c).alias("group_pair"), F.col(f"`{c}`").alias("cohens_d")) for c in matrix.columns if " vs " in c]
    none = F.expr("CAST(array() AS ARRAY<STRUCT<group_pair: STRING, cohens_d: DOUBLE>>)")
    rows = matrix.select("ancestry", "row_label", F.inline(F.array(*cells) if cells else none))
    return rounded(rows.filter("cohens_d IS NOT NULL"))
