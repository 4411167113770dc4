"""Counter and metric names, derived metrics, and the text labels built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The eight counters per sample and interval set.
COUNTERS = [
    "snp_ti_het", "snp_tv_het", "snp_ti_hom", "snp_tv_hom",
    "indel_ins_het", "indel_del_het", "indel_ins_hom", "indel_del_hom",
]

# The twelve metrics derived from them.
DERIVED = [
    "snp_het", "snp_hom", "snp_total", "titv_het", "titv_hom", "titv_total",
    "indel_het", "indel_hom", "indel_total", "delins_het", "delins_hom", "delins_total",
]

METRICS = COUNTERS + DERIVED

# The metrics that groups are compared on, with their display names.
KEY_METRICS = ["snp_total", "indel_total", "titv_total", "delins_total"]
DISPLAY_NAMES = {
    "snp_total": "SNP Count",
    "indel_total": "Indel Count",
    "titv_total": "Ti/Tv Ratio",
    "delins_total": "Del/Ins Ratio",
}

# Fixed values: |d| from which an effect is appreciable, and from which chart points are labelled.
APPRECIABLE = 0.5
LABELLED = 0.3


def number(value: Column) -> Column:
    """Numeric coercion: text that is no number, and NaN, become NULL."""
    parsed = value.try_cast("double")
    return F.nullif(parsed, F.lit(float("nan")))


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` with a NULL for a zero denominator."""
    return top.cast("double") / F.nullif(bottom, F.lit(0))


def derived_columns() -> list[Column]:
    """The twelve derived metrics as expressions over the eight counters."""
    c = {name: F.col(name) for name in COUNTERS}
    snp_het = c["snp_ti_het"] + c["snp_tv_het"]
    snp_hom = c["snp_ti_hom"] + c["snp_tv_hom"]
    indel_het = c["indel_ins_het"] + c["indel_del_het"]
    indel_hom = c["indel_ins_hom"] + c["indel_del_hom"]
    ti, tv = c["snp_ti_het"] + c["snp_ti_hom"], c["snp_tv_het"] + c["snp_tv_hom"]
    ins, dele = c["indel_ins_het"] + c["indel_ins_hom"], c["indel_del_het"] + c["indel_del_hom"]
    return [
        snp_het.alias("snp_het"),
        snp_hom.alias("snp_hom"),
        (snp_het + snp_hom).alias("snp_total"),
        ratio(c["snp_ti_het"], c["snp_tv_het"]).alias("titv_het"),
        ratio(c["snp_ti_hom"], c["snp_tv_hom"]).alias("titv_hom"),
        ratio(ti, tv).alias("titv_total"),
        indel_het.alias("indel_het"),
        indel_hom.alias("indel_hom"),
        (indel_het + indel_hom).alias("indel_total"),
        ratio(c["indel_del_het"], c["indel_ins_het"]).alias("delins_het"),
        ratio(c["indel_del_hom"], c["indel_ins_hom"]).alias("delins_hom"),
        ratio(dele, ins).alias("delins_total"),
    ]


def parse_metric(name: Column) -> Column:
    """``struct(set_name, metric_type)`` from ``{set}_{metric}``; longest suffix first."""
    chosen = None
    for metric in sorted(METRICS, key=len, reverse=True):
        suffix = "_" + metric
        hit = F.endswith(name, F.lit(suffix)) & (F.length(name) > len(suffix))
        value = F.struct(
            F.left(name, F.length(name) - len(suffix)).alias("set_name"),
            F.lit(metric).alias("metric_type"),
        )
        chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
    unknown = F.struct(F.lit("unknown").alias("set_name"), name.alias("metric_type"))
    return chosen.otherwise(unknown)


def parse_name(name: str) -> tuple[str, str]:
    """``parse_metric`` for a column name, which is known while the plan is built."""
    fitting = [m for m in METRICS if name.endswith("_" + m) and len(name) > len(m) + 1]
    if not fitting:
        return "unknown", name
    metric = max(fitting, key=len)
    return name[: -len(metric) - 1], metric


def display_metric(metric_type: Column) -> Column:
    """Human-readable metric name, or the name itself."""
    shown = metric_type
    for metric, text in DISPLAY_NAMES.items():
        shown = F.when(metric_type == metric, text).otherwise(shown)
    return shown


def severity(d: Column) -> Column:
    """``appreciable`` from the fixed threshold on; a missing effect is not."""
    return F.when(F.coalesce(F.abs(d) >= APPRECIABLE, F.lit(False)), "appreciable").otherwise("not appreciable")


def pair_label(x: Column, y: Column) -> Column:
    return F.concat_ws(" vs ", x, y)


def row_label(set_name: Column, metric_type: Column) -> Column:
    return F.concat_ws(" / ", set_name, display_metric(metric_type))


def starred(d: Column, p: Column) -> Column:
    """Effect with two decimals, a star for p < 0.05, empty for a missing effect."""
    # format_number rounds halves to even on the exact binary value, as printf does;
    # format_string would round the shortest decimal text half up.
    text = F.translate(F.format_number(d, 2), ",", "")
    star = F.when(F.coalesce(p < 0.05, F.lit(False)), "*").otherwise("")
    return F.when(d.isNull(), "").otherwise(F.concat(text, star))


def base_pairs(bp: Column) -> Column:
    """Base pairs as text in Gbp, Mbp, Kbp or bp."""
    value = bp.cast("double")
    return (
        F.when(bp >= 1_000_000_000, F.concat(F.format_number(value / 1_000_000_000, 2), F.lit(" Gbp")))
        .when(bp >= 1_000_000, F.concat(F.format_number(value / 1_000_000, 1), F.lit(" Mbp")))
        .when(bp >= 1_000, F.concat(F.format_number(value / 1_000, 1), F.lit(" Kbp")))
        .otherwise(F.concat(F.format_number(bp, 0), F.lit(" bp")))
    )
