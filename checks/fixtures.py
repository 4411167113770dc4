"""Genomic-looking inputs derived from the given tables.

The tables hold no genotypes, so labels, calls, intervals and sites are computed from them
by expressions that read the same in Spark SQL and DuckDB. Sizes grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.operators import bed
from cohortspark.shared import shared_path

# The interval sets, groups and strata that occur in the tables.
SETS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
GROUPS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
ANCESTRIES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
MIN_SAMPLES = 20
MIN_VALUES = 10
SEED = 42
# Positions in the fixtures are dense, one interval per 22 bp, so blocks are small.
BLOCK_BP = 64
PCA_METRICS = ["snp_ti_het", "indel_del_hom", "titv_total", "delins_het"]

CALL_COLUMNS = {
    "sample_id": "CAST(o_custkey AS STRING)",
    "contig": "concat('chr', CAST(1 + l_suppkey % 22 AS STRING))",
    "pos": "l_partkey",
    "ref": "CASE WHEN l_linenumber IN (1, 3, 5) THEN 'A' WHEN l_linenumber = 2 THEN 'C' "
    "WHEN l_linenumber = 4 THEN 'G' WHEN l_linenumber = 6 THEN 'ATG' ELSE 'AT' END",
    "alt": "CASE WHEN l_linenumber = 1 THEN 'G' WHEN l_linenumber IN (2, 4) THEN 'T' "
    "WHEN l_linenumber = 3 THEN 'C' WHEN l_linenumber = 5 THEN 'AT' "
    "WHEN l_linenumber = 6 THEN 'A' ELSE 'GC' END",
    "vfilter": "CASE WHEN (l_partkey + l_linenumber) % 4 = 0 THEN 'LowQual' "
    "WHEN (l_partkey + l_linenumber) % 4 = 1 THEN NULL ELSE 'PASS' END",
    "gt": "CASE WHEN l_quantity <= 5 THEN './.' WHEN l_quantity <= 10 THEN '0/0' "
    "WHEN l_linestatus = 'F' THEN '0/1' ELSE '1/1' END",
    "ft": "CASE WHEN l_tax = 0 THEN NULL WHEN l_discount > 0.08 THEN 'LowGQ' ELSE 'PASS' END",
}
INTERVAL_COLUMNS = {
    "set_name": "p_type",
    "contig": "concat('chr', CAST(1 + p_size % 22 AS STRING))",
    "start0": "p_partkey",
    "end0": "p_partkey + p_size",
}
SITE_COLUMNS = {
    "contig": "concat('chr', CAST(1 + p_partkey % 22 AS STRING))",
    "pos": "p_partkey",
    "ref": "'A'",
    "alts": "CASE WHEN p_partkey % 3 = 0 THEN 'G,T' ELSE 'G' END",
    "af1": "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 2000 END",
    "af2": "CASE WHEN p_partkey % 3 = 0 THEN CAST(51 - p_size AS DOUBLE) / 2000 END",
    "ac1": "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size * 3 END",
    "ac2": "CASE WHEN p_partkey % 3 = 0 THEN (51 - p_size) * 3 END",
}


def projection(columns: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in columns.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ancestry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region of every customer. Nation and region are dimension tables; Catalyst sizes the joins."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").cast("string").alias("sample_id"), F.col("r_name").alias("ancestry"))
    )


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("sample_id"), F.col("c_mktsegment").alias("grp")
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of one scan: sample_id, ancestry, grp."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").cast("string").alias("sample_id"),
            F.col("r_name").alias("ancestry"),
            F.col("c_mktsegment").alias("grp"),
        )
    )


def nation_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels whose groups, the nations, occur in one ancestry each."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").cast("string").alias("sample_id"), F.col("r_name").alias("ancestry"), F.col("n_name").alias("grp"))
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long calls with ``filters`` and allele numbers, as the call operators take them."""
    stored = {name: text for name, text in CALL_COLUMNS.items() if name not in ("vfilter", "gt")}
    # Allele numbers of the GT text in CALL_COLUMNS.
    numbers = {
        "a1": "CASE WHEN l_quantity <= 5 THEN NULL WHEN l_quantity <= 10 OR l_linestatus = 'F' THEN 0 ELSE 1 END",
        "a2": "CASE WHEN l_quantity <= 5 THEN NULL WHEN l_quantity <= 10 THEN 0 ELSE 1 END",
    }
    filters = {
        "filters": "CASE WHEN (l_partkey + l_linenumber) % 4 = 0 THEN array('LowQual') "
        "WHEN (l_partkey + l_linenumber) % 4 = 1 THEN NULL ELSE CAST(array() AS ARRAY<STRING>) END"
    }
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr(*projection({**stored, **numbers, **filters}))
    )


def bed_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval sets for the interval tools."""
    raw = table(spark, sf_dir, "part").selectExpr(*projection(INTERVAL_COLUMNS))
    return bed.standard_intervals(raw)


def site_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sets, 1-based closed, for matching sites."""
    raw = table(spark, sf_dir, "part").selectExpr(*projection(INTERVAL_COLUMNS))
    return raw.filter("end0 > start0").selectExpr("set_name", "contig", "start0 + 1 AS start", "end0 AS end")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "part").selectExpr(*projection(SITE_COLUMNS))
    return raw.selectExpr(
        "contig", "pos", "ref", "split(alts, ',') AS alts", "CAST(NULL AS ARRAY<STRING>) AS filters",
        "array(af1, af2) AS af", "array(ac1, ac2) AS ac",
        "CAST(array() AS ARRAY<STRUCT<sample_id: STRING, a1: INT, a2: INT, ft: STRING>>) AS calls",
    )


# --- VCF text: one line per part, one sample column per nation -----------------------------

#: Lines of a file, and cells of a file with a column per customer; such files are at most so many for each core.
SHARD_LINES, SHARD_CELLS, SHARDS_A_CORE = 4_000, 4_000_000, 4
VCF_ALLELES = {  # p_partkey % 6 -> REF, ALT
    0: ("A", "G"),
    1: ("A", "G,T"),
    2: ("ATG", "A,ATT"),
    3: ("CA", "C,TA"),
    4: ("C", "CT,*"),
    5: ("GCC", "GCT"),
}
VCF_GENOTYPES = {  # (7 * p_partkey + 11 * n_nationkey) % 10 -> GT with two alternates, with one
    0: ("./.", "./."),
    1: ("0/0", "0/0"),
    2: ("0/0", "0/0"),
    3: ("0|1", "0|1"),
    4: ("1/1", "1/1"),
    5: ("1/0", "1/0"),
    6: ("1/2", "0/1"),
    7: ("0/2", "1"),
    8: ("./1", "./1"),
    9: ("2/2", "0/0"),
}
VCF_FT = "CASE ({0} + {1}) % 7 WHEN 0 THEN 'LowGQ' WHEN 1 THEN '.' WHEN 2 THEN 'xPASSy' ELSE 'PASS' END"


def _case(subject: str, values: dict[int, str]) -> str:
    return f"CASE {subject} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in values.items()) + " END"


def vcf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VCF body lines; the sample cells are transformed over the array of nation keys."""
    keys = table(spark, sf_dir, "nation").agg(F.array_sort(F.collect_list("n_nationkey")).alias("k")).scalar()
    code = "(7 * p_partkey + 11 * n) % 10"
    two = "p_partkey % 6 BETWEEN 1 AND 4"
    gt = (
        f"CASE WHEN {two} THEN {_case(code, {k: v[0] for k, v in VCF_GENOTYPES.items()})} "
        f"ELSE {_case(code, {k: v[1] for k, v in VCF_GENOTYPES.items()})} END"
    )
    ft = VCF_FT.format("p_partkey", "n")
    cell = (
        f"CASE WHEN p_partkey % 7 = 0 THEN concat({gt}, ':30') "
        f"WHEN p_partkey % 2 = 0 THEN concat({gt}, ':', {ft}, ':30') "
        f"WHEN ({ft}) = '.' THEN {gt} ELSE concat({gt}, ':30:', {ft}) END"
    )
    fmt = "CASE WHEN p_partkey % 7 = 0 THEN 'GT:DP' WHEN p_partkey % 2 = 0 THEN 'GT:FT:DP' ELSE 'GT:DP:FT' END"
    af = (
        "concat(CASE WHEN p_partkey % 11 = 0 THEN '.' ELSE CAST(CAST(p_size AS DOUBLE) / 2000 AS STRING) END, "
        f"CASE WHEN {two} THEN concat(',', CAST(CAST(51 - p_size AS DOUBLE) / 2000 AS STRING)) ELSE '' END)"
    )
    ac = (
        "concat(CASE WHEN p_partkey % 13 = 0 THEN '.' ELSE CAST(p_size * 3 AS STRING) END, "
        f"CASE WHEN {two} THEN concat(',', CAST((51 - p_size) * 3 AS STRING)) ELSE '' END)"
    )
    flt = "CASE p_partkey % 5 WHEN 0 THEN 'LowQual' WHEN 1 THEN '.' WHEN 2 THEN 'LowQual;Depth' ELSE 'PASS' END"
    # Many shards, as cohort VCFs come: a gzip file is read by one task.
    part = table(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism)
    return part.withColumn("keys", keys).selectExpr(
        "concat_ws('\\t', concat('chr', CAST(1 + p_size % 22 AS STRING)), CAST(p_partkey + 5 AS STRING), '.', "
        f"{_case('p_partkey % 6', {k: v[0] for k, v in VCF_ALLELES.items()})}, "
        f"{_case('p_partkey % 6', {k: v[1] for k, v in VCF_ALLELES.items()})}, '50', {flt}, "
        f"concat('DP=10;AF=', {af}, ';AC=', {ac}), {fmt}, "
        f"concat_ws('\\t', transform(keys, n -> {cell}))) AS value"
    )


def _vcf_shards(spark: SparkSession, sf_dir: str, shards: int) -> DataFrame:
    """Lines of VCF files, header first, one partition per file."""
    names = table(spark, sf_dir, "nation").agg(
        F.concat_ws("\t", F.transform(
            F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda s: s["n_name"]
        )).alias("names")
    )
    # Every shard carries the header, as cohort VCFs do.
    header = F.array(
        F.lit("##fileformat=VCFv4.2"), F.concat(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"), F.col("names"))
    )
    heads = names.select("names", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")).select(
        "shard", F.posexplode(header).alias("line", "value")
    )
    body = vcf_lines(spark, sf_dir).select(F.pmod(F.xxhash64("value"), F.lit(shards)).cast("int").alias("shard"), F.lit(9).alias("line"), "value")
    # By number, not by its hash: no two shards meet in one file.
    return heads.union(body).repartitionById(shards, "shard").sortWithinPartitions("line").select("value")


def write_vcf(spark: SparkSession, sf_dir: str) -> str:
    """VCF files with header in the shared folder, more of them for more lines; returns their glob."""
    folder = shared_path(spark, "vcf")
    shards = max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "part").count() // SHARD_LINES))
    _vcf_shards(spark, sf_dir, shards).write.option("compression", "gzip").text(f"{folder}/calls.vcf")
    return f"{folder}/*.vcf"


def write_block_gzip(lines: DataFrame, folder: str, block: int = 4_000) -> str:
    """Block-gzip files of the lines, one per partition with rows, in small blocks; returns their glob.

    Each task writes a file named by its partition, so that a task that runs again writes the same file.
    """
    spark = lines.sparkSession
    spark.range(0).write.parquet(f"{folder}/made")

    def run(batches):
        import struct
        import zlib

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        def member(part):
            squeezed = zlib.compressobj(6, zlib.DEFLATED, -15)
            body = squeezed.compress(part) + squeezed.flush()
            size = struct.pack("<H", len(body) + 25)
            return b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff\x06\x00BC\x02\x00" + size + body + struct.pack("<II", zlib.crc32(part), len(part))

        where = folder if "://" in folder or folder.startswith("/") else "file://" + folder.removeprefix("file:")
        system, path = fs.FileSystem.from_uri(where)
        held, out = b"", None
        for batch in batches:
            for value in batch.column(0).to_pylist():
                out = out or system.open_output_stream(f"{path}/part-{TaskContext.get().partitionId()}.vcf.bgz")
                held += value.encode() + b"\n"
                while len(held) >= block:
                    out.write(member(held[:block]))
                    held = held[block:]
        if out:
            out.write(member(held) + member(b""))
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32())], ["n"])

    lines.mapInArrow(run, "n int").write.format("noop").mode("overwrite").save()
    return f"{folder}/*.vcf.bgz"


def write_vcf_bgz(spark: SparkSession, sf_dir: str) -> str:
    """The same calls in one block-gzip file."""
    return write_block_gzip(_vcf_shards(spark, sf_dir, 1), shared_path(spark, "vcf"))


WIDE_GENOTYPES = {0: "0/0", 1: "0/1", 2: "1/1", 3: "./.", 4: "0|0", 5: "1|0", 6: "0/0"}  # (supplier + 3 * customer) % 7


def write_wide_vcf(spark: SparkSession, sf_dir: str, packed: bool = True) -> str:
    """Sites from suppliers, one sample column per customer, gzip files of ``SHARD_CELLS`` cells or more; returns the glob.

    ``packed=False`` gives plain text in files of about ``SHARD_CELLS`` cells, which small tasks read.

    Suppliers are dealt to the files before they become text, so no line is shuffled. A file repeats the header, which is as wide
    as its lines, and a task that reads it sends up to a row per (sample, set); so there are no more files than keep the cores busy.
    """
    folder = shared_path(spark, "wide")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    shards = max(1, -(-customer.count() * supplier.count() // SHARD_CELLS))
    if packed:
        shards = min(shards, SHARDS_A_CORE * spark.sparkContext.defaultParallelism)
    customers = customer.agg(F.array_sort(F.collect_list("c_custkey")).alias("k"))
    head = "concat('#CHROM\\tPOS\\tID\\tREF\\tALT\\tQUAL\\tFILTER\\tINFO\\tFORMAT\\t', concat_ws('\\t', transform(k, c -> CAST(c AS STRING))))"
    # Looked up, where a CASE would work out its subject once per branch and cell.
    gt = f"get(array({', '.join(repr(v) for v in WIDE_GENOTYPES.values())}), CAST((s_suppkey + 3 * c) % 7 AS INT))"
    body = (
        "concat_ws('\\t', concat('chr', CAST(1 + s_nationkey % 22 AS STRING)), CAST(10 + s_suppkey AS STRING), '.', 'A', "
        "CASE WHEN s_suppkey % 2 = 0 THEN 'G' ELSE 'C' END, '9', 'PASS', '.', 'GT:FT', "
        f"concat_ws('\\t', transform(k, c -> concat({gt}, CASE WHEN (s_suppkey + c) % 5 = 0 THEN ':LowGQ' ELSE ':PASS' END))))"
    )
    # Every file carries the header.
    dealt = supplier.selectExpr(f"CAST(pmod(xxhash64(s_suppkey), {shards}) AS INT) AS shard", "1 AS line", "s_suppkey", "s_nationkey")
    heads = spark.range(shards).selectExpr("CAST(id AS INT) AS shard", "0 AS line", "NULL AS s_suppkey", "NULL AS s_nationkey")
    rows = heads.union(dealt).repartitionById(shards, "shard").sortWithinPartitions("line")
    rows.withColumn("k", customers.scalar()).selectExpr(f"CASE WHEN line = 0 THEN {head} ELSE {body} END AS value").write.option("compression", "gzip" if packed else "none").text(f"{folder}/wide.vcf")
    return f"{folder}/*.vcf"


def vcf_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_name AS sample_id", "r_name AS ancestry", "CASE WHEN n_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS grp"
    )
