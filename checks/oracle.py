"""DuckDB SQL for the same queries, written from the definitions and not from the Spark plans."""

from __future__ import annotations

import re

from cohortspark.functions.metrics import COUNTERS, DERIVED, DISPLAY_NAMES, KEY_METRICS, METRICS

from . import fixtures as fx


def _select(columns: dict[str, str]) -> str:
    return ", ".join(fx.projection(columns))


def _pairs() -> list[tuple[str, str]]:
    return [(x, y) for i, x in enumerate(fx.GROUPS) for y in fx.GROUPS[i + 1:]]


def _count(name: str) -> str:
    kind, zyg = name.split("_", 1)[1].rsplit("_", 1)
    return f"count(*) FILTER (WHERE allele_class = '{kind}' AND zygosity = '{zyg}')"


def _values(rows) -> str:
    text = []
    for row in rows:
        text.append("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")")
    return "VALUES " + ", ".join(text)


_DERIVED_SQL = {
    "snp_het": "snp_ti_het + snp_tv_het",
    "snp_hom": "snp_ti_hom + snp_tv_hom",
    "snp_total": "snp_ti_het + snp_tv_het + snp_ti_hom + snp_tv_hom",
    "titv_het": "CAST(snp_ti_het AS DOUBLE) / nullif(snp_tv_het, 0)",
    "titv_hom": "CAST(snp_ti_hom AS DOUBLE) / nullif(snp_tv_hom, 0)",
    "titv_total": "CAST(snp_ti_het + snp_ti_hom AS DOUBLE) / nullif(snp_tv_het + snp_tv_hom, 0)",
    "indel_het": "indel_ins_het + indel_del_het",
    "indel_hom": "indel_ins_hom + indel_del_hom",
    "indel_total": "indel_ins_het + indel_del_het + indel_ins_hom + indel_del_hom",
    "delins_het": "CAST(indel_del_het AS DOUBLE) / nullif(indel_ins_het, 0)",
    "delins_hom": "CAST(indel_del_hom AS DOUBLE) / nullif(indel_ins_hom, 0)",
    "delins_total": "CAST(indel_del_het + indel_del_hom AS DOUBLE) / nullif(indel_ins_het + indel_ins_hom, 0)",
}

_CLASS_SQL = """CASE WHEN ref || '>' || alt IN ('A>G', 'G>A', 'C>T', 'T>C') THEN 'ti'
  WHEN length(ref) = 1 AND length(alt) = 1 THEN 'tv'
  WHEN length(alt) > length(ref) AND starts_with(alt, ref) THEN 'ins'
  WHEN length(ref) > length(alt) AND starts_with(ref, alt) THEN 'del' ELSE 'other' END"""

# VCF fixture after splitting and trimming: code, alternate number, shift, ref, alt.
_SPLIT_ROWS = [
    (0, 1, 0, "A", "G"), (1, 1, 0, "A", "G"), (1, 2, 0, "A", "T"), (2, 1, 0, "ATG", "A"), (2, 2, 2, "G", "T"),
    (3, 1, 0, "CA", "C"), (3, 2, 0, "C", "T"), (4, 1, 0, "C", "CT"), (5, 1, 2, "C", "T"),
]
# Calls with an alternate allele: code, two alternates?, first allele, second allele.
_CALL_ROWS = [
    (3, 1, 0, 1), (3, 0, 0, 1), (4, 1, 1, 1), (4, 0, 1, 1), (5, 1, 1, 0), (5, 0, 1, 0),
    (6, 1, 1, 2), (6, 0, 0, 1), (7, 1, 0, 2), (7, 0, 1, None), (9, 1, 2, 2),
]

FRAGMENTS: dict[str, str] = {
    "fx_samples": """SELECT CAST(c_custkey AS VARCHAR) AS sample_id, r_name AS ancestry, c_mktsegment AS grp
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "fx_calls": f"SELECT {_select(fx.CALL_COLUMNS)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "fx_intervals": f"SELECT {_select(fx.INTERVAL_COLUMNS)} FROM part",
    "fx_sites": f"SELECT {_select(fx.SITE_COLUMNS)} FROM part",
    "passing": f"""SELECT *, {_CLASS_SQL} AS allele_class,
      CASE WHEN ft IS NOT NULL AND ft NOT LIKE '%PASS%' THEN NULL WHEN gt = '0/1' THEN 'het' WHEN gt = '1/1' THEN 'hom' END
        AS zygosity
      FROM fx_calls WHERE vfilter IS NULL OR vfilter = 'PASS'""",
    "member": """SELECT DISTINCT p.contig, p.pos, i.set_name
      FROM (SELECT DISTINCT contig, pos FROM fx_calls) p JOIN fx_intervals i
      ON p.contig = i.contig AND p.pos > i.start0 AND p.pos <= i.end0""",
    "counts": f"""SELECT s.sample_id, n.set_name, {", ".join(f"coalesce(c.{m}, 0) AS {m}" for m in COUNTERS)}
      FROM (SELECT DISTINCT sample_id FROM fx_calls) s CROSS JOIN (SELECT DISTINCT p_type AS set_name FROM part) n
      LEFT JOIN (SELECT sample_id, set_name, {", ".join(f"{_count(m)} AS {m}" for m in COUNTERS)}
                 FROM passing JOIN member USING (contig, pos) GROUP BY sample_id, set_name) c
      ON s.sample_id = c.sample_id AND n.set_name = c.set_name""",
    "stats": f"""SELECT c.*, ancestry, grp, {", ".join(f"{_DERIVED_SQL[m]} AS {m}" for m in DERIVED)}
      FROM counts c JOIN fx_samples USING (sample_id)""",
    "long_stats": " UNION ALL ".join(
        f"SELECT sample_id, ancestry, grp, set_name, '{m}' AS metric_type, CAST({m} AS DOUBLE) AS value FROM stats"
        for m in METRICS
    ),
    "key_stats": f"SELECT * FROM long_stats WHERE metric_type IN ({', '.join(repr(m) for m in KEY_METRICS)})",
    "moments": """SELECT ancestry, grp, set_name, metric_type, count(*) AS n_rows, count(value) AS n, avg(value) AS mean,
      stddev_pop(value) AS sd, var_samp(value) AS var FROM key_stats GROUP BY ALL""",
    "tested": f"""SELECT x.ancestry, x.grp AS group_x, y.grp AS group_y, x.set_name, x.metric_type,
      x.set_name || '_' || x.metric_type AS metric,
      x.mean AS mean_x, x.sd AS std_x, x.n AS n_x, y.mean AS mean_y, y.sd AS std_y, y.n AS n_y,
      x.var / x.n AS ex, y.var / y.n AS ey,
      (x.mean - y.mean) / nullif(sqrt(((x.n - 1) * x.sd ** 2 + (y.n - 1) * y.sd ** 2) / nullif(x.n + y.n - 2, 0)), 0) AS cohens_d
      FROM moments x JOIN moments y USING (ancestry, set_name, metric_type)
      WHERE x.grp < y.grp AND least(x.n_rows, y.n_rows) >= {fx.MIN_SAMPLES} AND least(x.n, y.n) >= {fx.MIN_VALUES}""",
    "welch": """SELECT *, abs(mean_x - mean_y) / sqrt(nullif(ex + ey, 0)) AS t,
      (ex + ey) ** 2 / nullif(ex ** 2 / nullif(n_x - 1, 0) + ey ** 2 / nullif(n_y - 1, 0), 0) AS df FROM tested""",
    # One minus twice Simpson's integral of the density over [0, t].
    "integral": """SELECT ancestry, group_x, group_y, metric,
      sum((CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END)
          * (1 + (t * k / 2000) ** 2 / df) ** (-(df + 1) / 2)) * any_value(t) / 6000
        * exp(lgamma((any_value(df) + 1) / 2) - lgamma(any_value(df) / 2)) / sqrt(any_value(df) * pi()) AS area
      FROM welch CROSS JOIN (SELECT unnest(range(2001)) AS k) WHERE t IS NOT NULL GROUP BY ALL""",
    "compared": """SELECT w.*, CASE WHEN w.t IS NOT NULL THEN greatest(1 - 2 * area, 0) WHEN ex + ey = 0 AND mean_x <> mean_y THEN 0.0 END AS p_value,
      group_x || ' vs ' || group_y AS group_pair
      FROM welch w LEFT JOIN integral USING (ancestry, group_x, group_y, metric)""",
    "flags": """SELECT *, abs(cohens_d) AS abs_d,
      CASE WHEN abs(cohens_d) >= 0.5 THEN 'appreciable' ELSE 'not appreciable' END AS severity
      FROM compared WHERE coalesce(abs(cohens_d) > 0.5, false) OR coalesce(p_value < 0.05, false)""",
    "named": _values(DISPLAY_NAMES.items()).join(["SELECT * FROM (", ") t(metric_type, metric_name)"]),
    "bed": """SELECT *, end0 - start0 AS width, CAST(substr(contig, 4) AS INTEGER) AS chrom_order FROM fx_intervals""",
    "totals": "SELECT set_name, CAST(sum(width) AS BIGINT) AS total_bp FROM bed GROUP BY set_name",
    "target": "SELECT min(total_bp) AS target_bp, (SELECT sum(width) FROM bed) AS all_bp FROM totals",
    "drawn": f"SELECT *, md5(concat_ws(':', '{fx.SEED}', contig, start0, end0, set_name)) AS k FROM bed",
    "strat": """SELECT d.*, sum(width) OVER (PARTITION BY contig ORDER BY k, contig, start0, end0, set_name ROWS UNBOUNDED PRECEDING) AS run,
      sum(width) OVER (PARTITION BY contig) AS whole, row_number() OVER (PARTITION BY contig ORDER BY width, k) AS narrow
      FROM drawn d""",
    "strat_kept": """SELECT contig, start0, end0, set_name, width, chrom_order FROM (
      SELECT *, greatest(1, floor(CAST(target_bp AS DOUBLE) * CAST(whole AS DOUBLE) / CAST(all_bp AS DOUBLE))) AS budget,
        min(run) OVER (PARTITION BY contig) AS least_run FROM strat, target)
      WHERE run <= budget OR (least_run > budget AND narrow = 1)""",
    "tight_kept": """SELECT contig, start0, end0, set_name, width, chrom_order FROM (
      SELECT *, greatest(1, floor(CAST(300 AS DOUBLE) * CAST(whole AS DOUBLE) / CAST(all_bp AS DOUBLE))) AS budget,
        min(run) OVER (PARTITION BY contig) AS least_run FROM strat, target)
      WHERE run <= budget OR (least_run > budget AND narrow = 1)""",
    "uniform_kept": """SELECT contig, start0, end0, set_name, width, chrom_order FROM (
      SELECT *, sum(width) OVER (ORDER BY k, contig, start0, end0, set_name ROWS UNBOUNDED PRECEDING) AS run FROM drawn), target
      WHERE run <= target_bp""",
    "vcf_codes": _values(_SPLIT_ROWS).join(["SELECT * FROM (", ") t(code, alt_no, shift, ref, alt)"]),
    "gt_codes": _values(_CALL_ROWS).join(["SELECT * FROM (", ") t(gcode, two, x1, x2)"]),
    "vcf_sites": """SELECT p_partkey, contig, pos + shift AS pos, ref, alt, alt_no, filters, two,
      CASE WHEN two = 1 THEN greatest(af1, af2) ELSE af1 END AS max_af, CASE WHEN two = 1 THEN greatest(ac1, ac2) ELSE ac1 END AS max_ac
      FROM (SELECT p_partkey, 'chr' || (1 + p_size % 22) AS contig, p_partkey + 5 AS pos, p_partkey % 6 AS code,
        CASE WHEN p_partkey % 6 BETWEEN 1 AND 4 THEN 1 ELSE 0 END AS two,
        CASE p_partkey % 5 WHEN 0 THEN 'LowQual' WHEN 1 THEN NULL WHEN 2 THEN 'LowQual;Depth' ELSE '' END AS filters,
        CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_size AS DOUBLE) / 2000 END AS af1, CAST(51 - p_size AS DOUBLE) / 2000 AS af2,
        CASE WHEN p_partkey % 13 <> 0 THEN p_size * 3 END AS ac1, (51 - p_size) * 3 AS ac2 FROM part) JOIN vcf_codes USING (code)""",
    "vcf_calls": f"""SELECT s.*, n_name AS sample_id, CAST(x1 = alt_no AS BIGINT) AS a1, CAST(x2 = alt_no AS BIGINT) AS a2,
      CASE WHEN p_partkey % 7 <> 0 THEN nullif({fx.VCF_FT.format('p_partkey', 'n_nationkey')}, '.') END AS ft
      FROM vcf_sites s CROSS JOIN nation JOIN gt_codes g
      ON (7 * p_partkey + 11 * n_nationkey) % 10 = gcode AND g.two = s.two
      WHERE x1 = alt_no OR coalesce(x2 = alt_no, false)""",
    "vcf_member": """SELECT DISTINCT c.contig, c.pos, i.set_name
      FROM (SELECT DISTINCT contig, pos FROM vcf_sites) c JOIN fx_intervals i
      ON c.contig = i.contig AND c.pos > i.start0 AND c.pos <= i.end0""",
    "vcf_counts": f"""SELECT s.n_name AS sample_id, n.set_name, r_name AS ancestry,
      CASE WHEN n_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS grp,
      {", ".join(f"coalesce(c.{m}, 0) AS {m}" for m in COUNTERS)}
      FROM nation s JOIN region ON n_regionkey = r_regionkey CROSS JOIN (SELECT DISTINCT p_type AS set_name FROM part) n
      LEFT JOIN (SELECT sample_id, set_name, {", ".join(f"{_count(m)} AS {m}" for m in COUNTERS)} FROM (
          SELECT sample_id, contig, pos, {_CLASS_SQL} AS allele_class,
            CASE WHEN a1 <> a2 THEN 'het' WHEN a1 = a2 THEN 'hom' END AS zygosity
          FROM vcf_calls WHERE (filters IS NULL OR filters = '') AND (ft IS NULL OR ft LIKE '%PASS%')
        ) JOIN vcf_member USING (contig, pos) GROUP BY ALL) c
      ON s.n_name = c.sample_id AND n.set_name = c.set_name""",
}


def _needed(sql: str) -> list[str]:
    """Fragments ``sql`` uses, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b[a-z_]+\b", text):
            if word in FRAGMENTS and word not in order:
                visit(FRAGMENTS[word])
                if word not in order:
                    order.append(word)

    visit(sql)
    return order


def build(sql: str) -> str:
    names = _needed(sql)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({FRAGMENTS[n]})" for n in names) + "\n" + sql


def _round(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


_SUMMARY = ["mean", "std", "count"]
_SUMMARY_SQL = {
    "mean": "round(avg({x}), 6)",
    "std": "round(stddev_samp({x}), 6)",
    "count": "count({x})",
}
_QUARTILES = """count(value) AS n, round(min(value), 6) AS min, round(max(value), 6) AS max,
  round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
  round(quantile_cont(value, 0.75), 6) AS q3"""
_BP = """CASE WHEN {0} >= 1000000000 THEN format('{{:,.2f}} Gbp', {0} / 1e9) WHEN {0} >= 1000000 THEN format('{{:,.1f}} Mbp', {0} / 1e6)
  WHEN {0} >= 1000 THEN format('{{:,.1f}} Kbp', {0} / 1e3) ELSE {0} || ' bp' END"""
_KEPT = "SELECT set_name, contig, start0, end0, width, chrom_order FROM {}"


def _breakdown(kept: str) -> str:
    return f"""SELECT coalesce(b.contig, a.contig) AS contig, input_intervals, input_bp, output_intervals, output_bp,
      CAST(substr(coalesce(b.contig, a.contig), 4) AS INTEGER) AS chrom_order FROM
      (SELECT contig, count(*) AS input_intervals, CAST(sum(width) AS BIGINT) AS input_bp FROM bed GROUP BY contig) b FULL JOIN
      (SELECT contig, count(*) AS output_intervals, CAST(sum(width) AS BIGINT) AS output_bp FROM {kept} GROUP BY contig) a
      ON a.contig = b.contig"""


_CROSS = """FROM (SELECT * FROM compared WHERE ancestry = {0}) x JOIN (SELECT * FROM compared WHERE ancestry = {1}) y
  USING (group_pair, metric)"""

_PADDED = "lpad(CAST(c_custkey AS VARCHAR), 9, '0')"

_FILE_ROWS = """(SELECT CASE WHEN p_partkey % 17 = 0 THEN 'chrUn_x' WHEN p_partkey % 19 = 0 THEN 'chrX'
  ELSE 'chr' || (1 + p_size % 22) END AS contig, p_partkey AS a,
  CASE WHEN p_size % 10 = 0 THEN p_partkey - p_size % 20 ELSE p_partkey + p_size END AS b FROM part)"""

_QUERIES: dict[str, str] = {
    "q_labels_merge": """SELECT ancestry, grp, count(*) AS n FROM fx_samples
      WHERE ancestry IN ('AFRICA', 'ASIA', 'EUROPE') AND grp IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')
      GROUP BY ancestry, grp""",
    "q_distinct_labels": """SELECT count(*) AS n_samples, count(DISTINCT ancestry) AS n_ancestries, count(DISTINCT grp) AS n_groups
      FROM fx_samples""",
    "q_unmatched_labels": """SELECT 'ancestry' AS side, count(*) AS n FROM orders WHERE o_orderkey * 3 NOT IN (SELECT p_partkey FROM part)
      UNION ALL SELECT 'group', count(*) FROM part WHERE p_partkey NOT IN (SELECT o_orderkey * 3 FROM orders)""",
    "q_subsample": f"""SELECT sample_id, ancestry, grp FROM (SELECT *,
      row_number() OVER (PARTITION BY ancestry, grp ORDER BY md5('{fx.SEED}:' || sample_id)) AS r,
      count(*) OVER (PARTITION BY ancestry, grp) AS n FROM fx_samples) WHERE r <= 50 AND n >= 50""",
    "q_site_filter": "SELECT contig, allele_class, zygosity, count(*) AS n FROM passing GROUP BY ALL",
    "q_freq_filter": "SELECT contig, pos, alts FROM fx_sites WHERE greatest(af1, af2) > 0.01 OR greatest(ac1, ac2) > 100",
    "q_split_multi": """SELECT contig, pos, ref, unnest(string_split(alts, ',')) AS alt, round(greatest(af1, af2), 6) AS max_af,
      CAST(greatest(ac1, ac2) AS BIGINT) AS max_ac FROM fx_sites""",
    "q_membership": "SELECT contig, pos, set_name FROM member",
    "q_membership_shuffled": """SELECT contig, pos, set_name, count(*) AS n_calls
      FROM fx_calls JOIN member USING (contig, pos) GROUP BY ALL""",
    "q_sample_counts": f"SELECT sample_id, set_name, {', '.join(COUNTERS)} FROM counts",
    "q_sample_wide": "SELECT sample_id, " + ", ".join(
        f"CAST(sum({m}) FILTER (WHERE set_name = '{s}') AS BIGINT) AS \"{s}_{m}\"" for s in fx.SETS for m in COUNTERS
    ) + " FROM counts GROUP BY sample_id",
    "q_derived": "SELECT sample_id, set_name, " + ", ".join(
        f"round({m}, 6) AS {m}" if m.startswith(("titv", "delins")) else m for m in DERIVED
    ) + " FROM stats",
    "q_group_summaries": "SELECT ancestry, grp, set_name, metric_type, "
    + ", ".join(f"{_SUMMARY_SQL[p].format(x='value')} AS {p}" for p in _SUMMARY)
    + " FROM long_stats GROUP BY ALL",
    "q_group_summaries_wide": "SELECT ancestry, grp, " + ", ".join(
        f"{_SUMMARY_SQL[p].format(x=f'CASE WHEN set_name = {s!r} THEN CAST({m} AS DOUBLE) END')} AS \"{s}_{m}_{p}\""
        for s in fx.SETS for m in METRICS for p in _SUMMARY
    ) + " FROM stats GROUP BY ancestry, grp",
    "q_pairwise_d": f"""SELECT 'segment' AS comparison, ancestry, group_x, group_y, metric, n_x, n_y,
      {_round('mean_x', 'std_x', 'mean_y', 'std_y', 'cohens_d')} FROM tested""",
    "q_pairwise_d_pooled": """SELECT ancestry, group_y AS group_x, group_x AS group_y, metric,
      round(sqrt(ey * n_y), 6) AS std_x, round(sqrt(ex * n_x), 6) AS std_y,
      round((mean_y - mean_x) / nullif(sqrt(((n_x - 1) * ex * n_x + (n_y - 1) * ey * n_y) / (n_x + n_y - 2)), 0), 6) AS cohens_d
      FROM tested""",
    "q_pairwise_p": """SELECT ancestry, group_x, group_y, metric, round(p_value, 6) AS p_value,
      CASE WHEN p_value > 1e-6 THEN round(-log10(p_value), 4) END AS neg_log10_p FROM compared""",
    "q_flagged": f"""SELECT ancestry, group_pair, set_name, metric_name, {_round('cohens_d', 'p_value')}, severity
      FROM flags JOIN named USING (metric_type)""",
    "q_flagged_top": f"""SELECT ancestry, group_pair, set_name, metric_name, {_round('cohens_d', 'p_value')}, severity
      FROM flags JOIN named USING (metric_type)
      ORDER BY round(abs_d, 9) DESC NULLS LAST, ancestry, group_pair, set_name, metric_type LIMIT 20""",
    "q_flag_totals": """SELECT (SELECT count(*) FROM compared) AS n_total, count(*) AS n_flagged,
      count(*) FILTER (WHERE abs_d >= 0.5) AS n_appreciable FROM flags""",
    "q_most_affected_sets": "SELECT set_name, count(*) AS n_flagged FROM flags GROUP BY set_name ORDER BY 2 DESC, 1 LIMIT 3",
    "q_volcano": """SELECT ancestry, group_pair, set_name, metric_type, round(cohens_d, 6) AS cohens_d,
      CASE WHEN -log10(nullif(p_value, 0)) < 6 THEN round(-log10(nullif(p_value, 0)), 4) END AS neg_log10_p,
      round(line, 6) AS bonferroni,
      coalesce(abs(cohens_d) > 0.5, false) AS beyond_threshold,
      coalesce(abs(cohens_d) > 0.3 AND -log10(nullif(p_value, 0)) > line, false) AS labelled
      FROM compared, (SELECT -log10(0.05 / count(*)) AS line FROM compared)""",
    "q_cross_stratum": f"""SELECT group_pair, metric, x.set_name, x.metric_type, x.ancestry AS ancestry_x, round(x.cohens_d, 6) AS d_x,
      y.ancestry AS ancestry_y, round(y.cohens_d, 6) AS d_y, group_pair || ' | ' || metric AS comparison_key,
      coalesce(greatest(abs(x.cohens_d), abs(y.cohens_d)) > 0.3 OR abs(x.cohens_d - y.cohens_d) > 0.3, false) AS labelled
      {_CROSS.format('(SELECT min(ancestry) FROM compared)',
                     '(SELECT min(ancestry) FROM compared WHERE ancestry > (SELECT min(ancestry) FROM compared))')}""",
    "q_cross_corr": f"SELECT count(*) AS n_matched, round(corr(x.cohens_d, y.cohens_d), 6) AS r {_CROSS.format(repr('ASIA'), repr('EUROPE'))}",
    "q_distributions": f"SELECT ancestry, grp, set_name, metric_type, {_QUARTILES} FROM key_stats WHERE value IS NOT NULL GROUP BY ALL",
    "q_distributions_drawn": f"""SELECT ancestry, grp, set_name, metric_type, {_QUARTILES} FROM key_stats
      WHERE value IS NOT NULL AND sample_id IN (SELECT sample_id FROM (SELECT sample_id,
        row_number() OVER (PARTITION BY ancestry, grp ORDER BY md5('{fx.SEED}:' || sample_id)) AS r
        FROM (SELECT DISTINCT sample_id, ancestry, grp FROM stats)) WHERE r <= 40) GROUP BY ALL""",
    "q_sample_sizes": "SELECT grp, " + ", ".join(
        f"max(n) FILTER (WHERE ancestry = '{a}') AS \"{a}\"" for a in fx.ANCESTRIES
    ) + """ FROM (SELECT ancestry, group_x AS grp, n_x AS n FROM tested UNION ALL
      SELECT ancestry, group_y, n_y FROM tested) GROUP BY grp""",
    "q_metric_parse": """SELECT p_partkey, name, set_name, m.metric_type, coalesce(metric_name, m.metric_type) AS metric_name FROM (
      SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'GC_gt_' || p_size || '_indel_total' WHEN 1 THEN p_type || '_snp_ti_het'
        WHEN 2 THEN '_snp_total' WHEN 3 THEN 'foo' || p_size ELSE p_type || '_snp_het' END AS name,
      CASE p_partkey % 5 WHEN 0 THEN 'GC_gt_' || p_size WHEN 1 THEN p_type WHEN 4 THEN p_type ELSE 'unknown' END AS set_name,
      CASE p_partkey % 5 WHEN 0 THEN 'indel_total' WHEN 1 THEN 'snp_ti_het' WHEN 2 THEN '_snp_total'
        WHEN 3 THEN 'foo' || p_size ELSE 'snp_het' END AS metric_type FROM part) m LEFT JOIN named USING (metric_type)""",
    "q_interval_summary": f"""SELECT set_name, count(*) AS intervals, CAST(sum(width) AS BIGINT) AS total_bp,
      CAST(floor(avg(width)) AS BIGINT) AS mean_width, CAST(floor(median(width)) AS BIGINT) AS median_width,
      {_BP.format('sum(width)')} AS total_bp_text, round(100 * sum(width) / 3088269832.0::DOUBLE, 6) AS percent_grch38
      FROM bed GROUP BY set_name""",
    "q_chrom_coverage": """SELECT s.set_name, k.contig, CAST(coalesce(sum(width), 0) AS BIGINT) AS total_bp, chrom_order FROM
      (SELECT DISTINCT set_name FROM bed) s CROSS JOIN
      (SELECT 'chr' || CASE n WHEN 23 THEN 'X' WHEN 24 THEN 'Y' ELSE CAST(n AS VARCHAR) END AS contig, CAST(n AS INTEGER) AS chrom_order
       FROM (SELECT unnest(range(1, 25)) AS n)) k
      LEFT JOIN (SELECT set_name, contig, width FROM bed) b ON b.set_name = s.set_name AND b.contig = k.contig
      GROUP BY s.set_name, k.contig, chrom_order""",
    "q_width_dist": f"SELECT set_name, {_QUARTILES} FROM (SELECT set_name, CAST(width AS DOUBLE) AS value FROM bed) GROUP BY set_name",
    "q_match_target": """SELECT 'max' AS stat, max(total_bp) AS target_bp FROM totals UNION ALL SELECT 'min', min(total_bp) FROM totals
      UNION ALL SELECT 'median', CAST(floor(median(total_bp)) AS BIGINT) FROM totals
      UNION ALL SELECT 'mean', CAST(floor(avg(total_bp)) AS BIGINT) FROM totals""",
    "q_dominance": """SELECT largest, largest_bp, second, second_bp, round(CAST(largest_bp AS DOUBLE) / second_bp, 6) AS ratio,
      CAST(largest_bp AS DOUBLE) / second_bp > 5 AS downsample, which AS "case" FROM (
      SELECT which, max(set_name) FILTER (WHERE r = 1) AS largest, max(total_bp) FILTER (WHERE r = 1) AS largest_bp,
        max(set_name) FILTER (WHERE r = 2) AS second, max(total_bp) FILTER (WHERE r = 2) AS second_bp FROM (
        SELECT *, row_number() OVER (PARTITION BY which ORDER BY total_bp DESC, set_name) AS r FROM (
          SELECT 'sets' AS which, * FROM totals UNION ALL
          SELECT 'rest', CASE WHEN set_name = 'SMALL' THEN 'SMALL' ELSE 'REST' END, CAST(sum(total_bp) AS BIGINT) FROM totals GROUP BY 2))
      GROUP BY which)""",
    "q_downsample_strat": _KEPT.format("strat_kept"),
    "q_downsample_tight": _KEPT.format("tight_kept"),
    "q_downsample_uniform": _KEPT.format("uniform_kept"),
    "q_downsample_breakdown": _breakdown("uniform_kept"),
    "q_downsample_totals": f"""SELECT CAST(sum(input_intervals) AS BIGINT) AS input_intervals, CAST(sum(input_bp) AS BIGINT) AS input_bp,
      CAST(sum(output_intervals) AS BIGINT) AS output_intervals, CAST(sum(output_bp) AS BIGINT) AS output_bp,
      round(100 * (1 - CAST(sum(output_bp) AS DOUBLE) / sum(input_bp)), 6) AS reduction_percent,
      round(100 * sum(input_bp) / 3088269832.0::DOUBLE, 6) AS input_percent_grch38,
      round(100 * sum(output_bp) / 3088269832.0::DOUBLE, 6) AS output_percent_grch38 FROM ({_breakdown('strat_kept')})""",
    "q_sampled_export": "SELECT sample_id, " + ", ".join(
        f"CAST(sum({m}) FILTER (WHERE set_name = '{s}') AS BIGINT) AS \"{s}_{m}\"" for s in fx.SETS for m in ("snp_ti_het", "indel_del_hom")
    ) + f" FROM counts GROUP BY sample_id ORDER BY md5('{fx.SEED}:' || sample_id) LIMIT 400",
    "q_tsv_labels": f"""SELECT {_PADDED} AS sample_id, CAST(c_nationkey AS VARCHAR) AS ancestry,
      CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 17 <> 0 THEN 'site' || c_custkey % 5 END AS grp
      FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
    "q_interval_files": f"""SELECT 'tool' AS reader, contig, a, b FROM {_FILE_ROWS} WHERE contig <> 'chrUn_x'
      UNION ALL SELECT 'bed', contig, a + 1, b FROM {_FILE_ROWS} WHERE b > a UNION ALL SELECT 'list', contig, a, b FROM {_FILE_ROWS}""",
    "q_vcf_sites": """SELECT contig, pos, ref, alt, filters, round(max_af, 6) AS max_af, CAST(max_ac AS BIGINT) AS max_ac FROM vcf_sites""",
    "q_vcf_calls": "SELECT contig, pos, ref, alt, sample_id, a1, a2, ft FROM vcf_calls WHERE max_af > 0.01 OR max_ac > 100",
    "q_vcf_metrics": "SELECT sample_id, set_name, " + ", ".join(COUNTERS) + ", ancestry, grp, " + ", ".join(
        f"round({_DERIVED_SQL[m]}, 6) AS {m}" if m.startswith(("titv", "delins")) else f"{_DERIVED_SQL[m]} AS {m}" for m in DERIVED
    ) + " FROM vcf_counts",
    "q_results_comparisons": f"""SELECT 'segment' AS comparison, ancestry, group_x || ' vs ' || group_y AS group_pair, set_name,
      metric_type, n_x, n_y, {_round('mean_x', 'cohens_d')} FROM tested""",
    "q_results_distributions": f"SELECT ancestry, grp, set_name, metric_type, {_QUARTILES} FROM key_stats WHERE value IS NOT NULL GROUP BY ALL",
}
_QUERIES["q_vcf_bgz"] = _QUERIES["q_vcf_sites"]
_WIDE_GT = "CASE (s_suppkey + 3 * c_custkey) % 7 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in fx.WIDE_GENOTYPES.items()) + " END"
_QUERIES["q_vcf_customers"] = f"""WITH w AS (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment = 'BUILDING'),
 place AS (SELECT DISTINCT s_suppkey, p_type AS set_name FROM supplier JOIN part ON 1 + p_size % 22 = 1 + s_nationkey % 22
   AND 10 + s_suppkey > p_partkey AND 10 + s_suppkey <= p_partkey + p_size),
 g AS (SELECT c_custkey, set_name, s_suppkey % 2 = 0 AS ti, {_WIDE_GT} AS gt FROM place JOIN supplier USING (s_suppkey), w WHERE (s_suppkey + c_custkey) % 5 <> 0),
 n AS (SELECT c_custkey, set_name, count(*) FILTER (WHERE ti AND gt IN ('0/1', '1|0')) AS a, count(*) FILTER (WHERE NOT ti AND gt IN ('0/1', '1|0')) AS b,
   count(*) FILTER (WHERE ti AND gt = '1/1') AS c, count(*) FILTER (WHERE NOT ti AND gt = '1/1') AS d FROM g GROUP BY ALL)
 SELECT CAST(w.c_custkey AS VARCHAR) AS sample_id, s.set_name, coalesce(a, 0) AS snp_ti_het, coalesce(b, 0) AS snp_tv_het, coalesce(c, 0) AS snp_ti_hom,
   coalesce(d, 0) AS snp_tv_hom, 0::BIGINT AS indel_ins_het, 0::BIGINT AS indel_del_het, 0::BIGINT AS indel_ins_hom, 0::BIGINT AS indel_del_hom
 FROM w CROSS JOIN (SELECT unnest({fx.SETS!r}) AS set_name) s LEFT JOIN n ON n.c_custkey = w.c_custkey AND n.set_name = s.set_name"""
_QUERIES["q_vcf_zones"] = """SELECT contig, min(pos) AS lo, max(pos) AS hi, count(*) AS sites, CAST(sum(n) AS BIGINT) AS calls FROM (
   SELECT contig, pos, (SELECT count(*) FROM nation WHERE (7 * p_partkey + 11 * n_nationkey) % 10 BETWEEN 3 AND CASE WHEN two THEN 9 ELSE 8 END) AS n
   FROM vcf_sites) GROUP BY contig"""
_QUERIES["q_vcf_metrics_bitmap"] = _QUERIES["q_vcf_metrics"]
_QUERIES["q_sample_counts_bitmap"] = _QUERIES["q_vcf_customers"]
_QUERIES["q_membership_sweep"] = _QUERIES["q_membership"] + """ UNION SELECT DISTINCT contig, pos, 'WHOLE' FROM fx_calls WHERE contig = 'chr7'"""
_QUERIES["q_interval_files_skipped"] = """SELECT 'good' AS set_name, 'chr1' AS contig, CAST(p_partkey + 1 AS BIGINT) AS a, CAST(p_partkey + p_size AS BIGINT) AS b
  FROM part WHERE p_size > 0"""


def _pca_sql(rows: str, stratum: str, keys: list[str], features: list[str], squarings: int = 14) -> str:
    """Two components per stratum of at least ten rows: a correlation matrix squared until one component is left, taken out, and again.

    A component's projector gives its strength and, by its largest diagonal cell, its axis with that loading positive.
    """
    whole = ", ".join(keys)
    values = ", ".join(f"coalesce(CAST({f} AS DOUBLE), 0)" for f in features)
    ctes = [
        f"o AS (SELECT row_number() OVER () AS id, {stratum} AS s, {whole}, [{values}] AS x FROM ({rows}) WHERE {stratum} IS NOT NULL)",
        f"u AS (SELECT id, s, unnest(range({len(features)})) AS i, unnest(x) AS x FROM o)",
        "g AS (SELECT s, i, count(*) AS n, avg(x) AS mean, stddev_pop(x) AS sd FROM u GROUP BY s, i)",
        "z AS (SELECT id, s, i, n, CASE WHEN sd > 0 THEN (x - mean) / sd ELSE 0 END AS z FROM u JOIN g USING (s, i) WHERE n >= 10)",
        "r1 AS MATERIALIZED (SELECT a.s, a.i, b.i AS j, sum(a.z * b.z) / any_value(a.n) AS v FROM z a JOIN z b USING (id) GROUP BY a.s, a.i, b.i)",
        "t AS (SELECT s, sum(v) AS v FROM r1 WHERE i = j GROUP BY s)",
    ]
    for c in (1, 2):
        ctes.append(f"m{c}_0 AS MATERIALIZED (SELECT s, i, j, r.v / t.v AS v FROM r{c} r JOIN (SELECT s, sum(v) AS v FROM r{c} WHERE i = j GROUP BY s) t USING (s))")
        for k in range(squarings):
            ctes.append(f"q{c}_{k} AS MATERIALIZED (SELECT a.s, a.i, b.j, sum(a.v * b.v) AS v FROM m{c}_{k} a JOIN m{c}_{k} b ON a.s = b.s AND a.j = b.i GROUP BY a.s, a.i, b.j)")
            ctes.append(f"m{c}_{k + 1} AS MATERIALIZED (SELECT q.s, i, j, q.v / t.v AS v FROM q{c}_{k} q JOIN (SELECT s, sum(v) AS v FROM q{c}_{k} WHERE i = j GROUP BY s) t USING (s))")
        p = f"m{c}_{squarings}"
        ctes.append(f"l{c} AS (SELECT r.s, sum(r.v * p.v) AS v FROM r{c} r JOIN {p} p USING (s, i, j) GROUP BY r.s)")
        ctes.append(f"a{c} AS (SELECT s, i, p.v / sqrt(d.v) AS v FROM {p} p JOIN (SELECT s, arg_max(i, v) AS j, max(v) AS v FROM {p} WHERE i = j GROUP BY s) d USING (s, j))")
        ctes.append(f"pc{c} AS (SELECT z.id, sum(z.z * a{c}.v) AS pc FROM z JOIN a{c} USING (s, i) GROUP BY z.id)")
        if c == 1:
            ctes.append(f"r2 AS MATERIALIZED (SELECT s, i, j, r.v - l.v * p.v AS v FROM r1 r JOIN {p} p USING (s, i, j) JOIN l1 l USING (s))")
    names = ", ".join(dict.fromkeys([f"o.s AS {stratum}", *[f"o.{k}" for k in keys if k != stratum]]))
    return f"""SELECT * FROM (WITH {', '.join(ctes)}
      SELECT {names}, round(pc1.pc, 4) AS pc1, round(pc2.pc, 4) AS pc2, round(100 * l1.v / t.v, 4) AS percent_1, round(100 * l2.v / t.v, 4) AS percent_2
      FROM o JOIN pc1 USING (id) JOIN pc2 USING (id) JOIN l1 ON l1.s = o.s JOIN l2 ON l2.s = o.s JOIN t ON t.s = o.s)"""


_WIDE = [f"{name}_{m}" for name in fx.SETS for m in METRICS]
_QUERIES["q_metric_pca"] = _pca_sql(
    "SELECT sample_id, ancestry, grp, " + ", ".join(f"max({m}) FILTER (WHERE set_name = '{name}') AS {name}_{m}" for name in fx.SETS for m in METRICS)
    + " FROM stats GROUP BY ALL", "ancestry", ["sample_id", "grp"], _WIDE)
_QUERIES["q_embedding_pca"] = _pca_sql("SELECT * FROM embeddings", "label", ["vec_id"], [f"embedding[{i + 1}]" for i in range(64)])
_QUERIES["q_results_summaries"] = _QUERIES["q_group_summaries"]
_QUERIES["q_report_distributions"] = _QUERIES["q_results_distributions"]
_QUERIES["q_downsample_manifest"] = f"""SELECT contig, CAST({fx.SEED} AS BIGINT) AS seed, '1.5 Kbp' AS bp_text, input_intervals, input_bp,
  output_intervals, output_bp FROM ({_breakdown("uniform_kept")})"""
_QUERIES["q_bed_roundtrip"] = "SELECT contig, start0, end0 FROM strat_kept"
_QUERIES["q_vcf_cache_options"] = """SELECT 'all' AS import, contig, pos, ref, alt FROM vcf_sites
  UNION ALL SELECT 'frequent', contig, pos, ref, alt FROM vcf_sites WHERE max_af > 0.01 OR max_ac > 100"""
_QUERIES["q_heatmap_reversed"] = """SELECT ancestry, set_name || ' / ' || metric_name AS row_label, group_y || ' vs ' || group_x AS group_pair,
  round(-cohens_d, 6) AS cohens_d FROM compared JOIN named USING (metric_type) WHERE cohens_d IS NOT NULL"""
_PCA_PAIRS = [(i, j) for i in range(len(fx.PCA_METRICS)) for j in range(i, len(fx.PCA_METRICS))]
_QUERIES["q_pca_moments"] = " UNION ALL ".join(
    f"""SELECT ancestry, {i} AS i, {j} AS j, count(*) AS n, round(avg(coalesce({fx.PCA_METRICS[i]}, 0)), 6) AS mean_i,
  round(corr(coalesce({fx.PCA_METRICS[i]}, 0), coalesce({fx.PCA_METRICS[j]}, 0)), 6) AS r FROM stats GROUP BY ancestry""" for i, j in _PCA_PAIRS
)

for _name, _value in (("q_heatmap", "cohens_d"), ("q_heatmap_p", "p_value")):
    _QUERIES[_name] = "SELECT ancestry, set_name || ' / ' || metric_name AS row_label, " + ", ".join(
        f"round(max({_value}) FILTER (WHERE group_x = '{x}' AND group_y = '{y}'), 6) AS \"{x} vs {y}\"" for x, y in _pairs()
    ) + " FROM compared JOIN named USING (metric_type) GROUP BY ALL"
_QUERIES["q_heatmap_text"] = """SELECT ancestry, set_name || ' / ' || metric_name AS row_label, group_pair,
  CASE WHEN cohens_d IS NULL THEN '' ELSE format('{:.2f}', cohens_d) || CASE WHEN coalesce(p_value < 0.05, false) THEN '*' ELSE '' END END
  AS cell_text FROM compared JOIN named USING (metric_type)"""


def small_groups_sql() -> str:
    """Effects of groups of a few samples: the same moments over finer strata, without minimums."""
    text = build(f"""SELECT ancestry, group_x, group_y, metric, n_x, n_y, {_round('cohens_d')},
      (t IS NOT NULL AND df IS NOT NULL) OR coalesce(ex + ey = 0 AND mean_x <> mean_y, false) AS has_p FROM welch""")
    text = text.replace("SELECT c.*, ancestry, grp,", "SELECT c.*, ancestry || CAST(sample_id AS BIGINT) % 40 AS ancestry, grp,")
    return text.replace(f"least(x.n_rows, y.n_rows) >= {fx.MIN_SAMPLES} AND least(x.n, y.n) >= {fx.MIN_VALUES}", "least(x.n, y.n) >= 1")


def group_means_sql() -> str:
    """Groups that each occur in one ancestry only; every other cell is filled with 0."""
    text = build("""SELECT a.ancestry, g.grp, s.set_name, s.metric_type, metric_name,
      CASE WHEN count(k.sample_id) = 0 THEN 0.0 ELSE round(avg(value), 6) END AS mean,
      CASE WHEN count(k.sample_id) = 0 THEN 0.0 ELSE round(stddev_samp(value), 6) END AS std
      FROM (SELECT DISTINCT ancestry FROM key_stats) a CROSS JOIN (SELECT DISTINCT grp FROM key_stats) g
      CROSS JOIN (SELECT DISTINCT set_name, metric_type FROM key_stats) s JOIN named USING (metric_type)
      LEFT JOIN key_stats k ON k.ancestry = a.ancestry AND k.grp = g.grp AND k.set_name = s.set_name AND k.metric_type = s.metric_type
      GROUP BY ALL""")
    return text.replace("c_mktsegment AS grp", "n_name AS grp")


def flagship_sql() -> str:
    """The comparison chain with all samples in one stratum."""
    text = build(f"""SELECT ancestry, group_x, group_y, metric, n_x, n_y,
      {_round('mean_x', 'mean_y', 'cohens_d', 'p_value')} FROM compared""")
    return text.replace("SELECT c.*, ancestry, grp,", "SELECT c.*, 'all' AS ancestry, grp,")


def oracle_sql() -> dict[str, str]:
    return {**{name: build(sql) for name, sql in _QUERIES.items()}, "q_flagship": flagship_sql(), "q_pairwise_small": small_groups_sql(), "q_group_means": group_means_sql()}
