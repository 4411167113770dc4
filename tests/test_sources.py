import gzip
import random
import struct
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from cohortspark.operators import calls as call_ops
from cohortspark.operators.samples import wanted_words
from cohortspark.sources import blocks, callset, files, intervals, labels, results, zones
from cohortspark.sources.vcf import Callset, read_vcf


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())

HEADER = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\ts3"]
LINES = [
    "chr1\t100\t.\tA\tG\t50\tPASS\tDP=9;AF=0.02;AC=3\tGT:FT:DP\t0/1:PASS:3\t1|1:LowGQ:4\t./.",
    "chr1\t200\t.\tA\tG,AT\t50\t.\tAF=0.001,.;AC=7,101\tDP:GT\t3:1/2\t3:0/2\t3:0/0",
    "chr2\t300\t.\tACG\tACT,*\t50\tLowQual;Depth\tXAF=0.9\tGT\t1\t./1\t0/1",
    "chr3\t400\t.\tA\t.\t50\tPASS\t.\tGT\t0/0\t0/0\t0/0",
]


def calls_of(sites):
    exploded = sites.select("contig", "pos", "ref", "alt", F.explode("calls").alias("c"))
    return {(r.contig, r.pos, r.ref, r.alt, r.c.sample_id): (r.c.a1, r.c.a2, r.c.ft) for r in exploded.collect()}


def test_vcf_site_rows(spark, text_file):
    data = read_vcf(spark, text_file("a.vcf", *HEADER, *LINES))
    rows = {r.pos: r for r in data.sites.collect()}
    assert [r.sample_id for r in data.samples.orderBy("sample_id").collect()] == ["s1", "s2", "s3"]
    assert rows[100].filters == [] and rows[200].filters is None and rows[300].filters == ["LowQual", "Depth"]
    assert rows[200].af == [0.001, None] and rows[200].ac == [7, 101] and rows[300].af is None
    assert [(c.sample_id, c.a1, c.a2, c.ft) for c in rows[100].calls] == [("s1", 0, 1, "PASS"), ("s2", 1, 1, "LowGQ")]
    # FORMAT order varies, and a haploid call keeps a NULL second allele; ./1 is no call.
    assert [(c.sample_id, c.a1, c.a2) for c in rows[200].calls] == [("s1", 1, 2), ("s2", 0, 2)]
    assert [(c.sample_id, c.a1, c.a2) for c in rows[300].calls if c.a1 is not None] == [("s1", 1, None), ("s3", 0, 1)]
    assert rows[400].calls == []


def test_vcf_split(spark, text_file):
    data = callset.import_vcf(spark, text_file("a.vcf", *HEADER, *LINES))
    got = calls_of(call_ops.passing_sites(data.sites))
    assert got == {
        ("chr1", 100, "A", "G", "s1"): (0, 1, "PASS"), ("chr1", 100, "A", "G", "s2"): (1, 1, "LowGQ"),
        ("chr1", 200, "A", "G", "s1"): (1, 0, None), ("chr1", 200, "A", "G", "s2"): (0, 0, None),
        ("chr1", 200, "A", "AT", "s1"): (0, 1, None), ("chr1", 200, "A", "AT", "s2"): (0, 1, None),
    }
    sites = {(r.contig, r.pos, r.ref, r.alt) for r in data.sites.collect()}
    assert ("chr2", 302, "G", "T") in sites  # trimmed and moved; the * allele gives no row
    assert len(sites) == 4


def test_vcf_unsplit_and_frequency(spark, text_file):
    path = text_file("a.vcf", *HEADER, *LINES)
    plain = callset.import_vcf(spark, path, split_multi=False)
    assert {(r.pos, r.alt) for r in plain.sites.collect()} == {(100, "G"), (200, "G"), (300, "ACT"), (400, ".")}
    frequent = callset.import_vcf(spark, path, frequency_filter=True)
    assert {(r.pos, r.alt) for r in frequent.sites.collect()} == {(100, "G"), (200, "G"), (200, "AT")}


def test_vcf_gzip_members_and_samples(spark, tmp_path):
    path = tmp_path / "a.vcf.gz"
    blocks = ["\n".join(HEADER + LINES[:1]) + "\n", "\n".join(LINES[1:]) + "\n"]
    path.write_bytes(b"".join(gzip.compress(b.encode()) for b in blocks))
    data = read_vcf(spark, str(path), keep_samples=["s3", "s1", "elsewhere"], spread=3)
    assert {r.sample_id for r in data.samples.collect()} == {"s1", "s3"}
    assert data.sites.count() == 4
    assert {c.sample_id for r in data.sites.collect() for c in r.calls} == {"s1", "s3"}
    assert read_vcf(spark, str(path), keep_samples=["nobody"]).samples.count() == 0


def test_frequency_threshold_is_strict(spark):
    rows = [([0.01], [100]), ([0.001, 0.02], [1]), (None, [101]), (None, None), ([0.02], None)]
    df = spark.createDataFrame(rows, "af array<double>, ac array<int>")
    assert call_ops.frequent_sites(df, 0.01, 100).count() == 3


def test_trimming(spark):
    df = spark.createDataFrame(
        [("A", "G"), ("CA", "TA"), ("GCC", "GCT"), ("ATTA", "ATA"), ("CAGAG", "CAG"), ("TT", "TT"), ("AGGT", "ACCT")],
        "ref string, alt string",
    ).withColumn("pos", F.lit(10))
    got = [(r.pos, r.ref, r.alt) for r in call_ops.trim_alleles(df).collect()]
    assert got == [(10, "A", "G"), (10, "C", "T"), (12, "C", "T"), (10, "AT", "A"), (10, "CAG", "C"), (10, "T", "T"),
                   (11, "GG", "CC")]


def test_cache_is_reused_and_partial_is_rebuilt(spark, text_file, tmp_path):
    source, cache = text_file("a.vcf", *HEADER, *LINES), str(tmp_path / "cache")
    assert callset.cached_import(spark, source, cache).sites.count() == 4
    imports = lambda: sorted(p.name for p in (tmp_path / "cache").glob("import-*"))
    first = imports()
    assert callset.cached_import(spark, source, cache).sites.count() == 4 and imports() == first
    # Other options and other input are other imports.
    assert callset.cached_import(spark, source, cache, frequency_filter=True).sites.count() == 3
    assert callset.cached_import(spark, source, cache).sites.count() == 4
    text_file("a.vcf", *HEADER, *LINES[:1])
    assert callset.cached_import(spark, source, cache).sites.count() == 1
    held = imports()
    assert callset.cached_import(spark, source, cache, force=True).sites.count() == 1 and len(imports()) == len(held) + 1
    # An import that died before it was published is never read.
    callset.write_callset(callset.import_vcf(spark, text_file("b.vcf", *HEADER, *LINES)), f"{cache}/import-dead")
    assert callset.read_callset(spark, cache).sites.count() == 1
    (tmp_path / "cache" / "current" / "_SUCCESS").unlink()
    assert callset.cached_import(spark, source, cache).sites.count() == 1


def test_vcf_headers_must_agree(spark, tmp_path):
    def shards(name, *heads):
        folder = tmp_path / name
        folder.mkdir()
        for i, head in enumerate(heads):
            lines = [*head, "\t".join(["chr1", str(i + 1), ".", "A", "G", "9", "PASS", "AC=1", "GT", "0/1", "0/0"])]
            (folder / f"{i}.vcf").write_text("".join(line + "\n" for line in lines))
        return f"{folder}/*.vcf"

    columns = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]
    head = lambda *names: ["##fileformat=VCFv4.2", "\t".join([*columns, *names])]
    same = read_vcf(spark, shards("same", head("s1", "s2"), head("s1", "s2")))
    assert [c.sample_id for r in same.sites.collect() for c in r.calls] == ["s1", "s1"]
    for name, heads, message in (
        ("swapped", [head("s1", "s2"), head("s2", "s1")], "disagree"), ("unequal", [head("s1", "s2"), head("s1", "s2", "s3")], "disagree"),
        ("bare", [head("s1", "s2"), []], "no #CHROM line in"), ("none", [[], []], "no #CHROM line"), ("twice", [head("s1", "s1")], "repeat"),
    ):
        with pytest.raises(ValueError, match=message):
            read_vcf(spark, shards(name, *heads))


def block_gzip(data, block=300):
    """Block-gzip bytes of a text, small blocks, with the empty block at the end."""
    out = b""
    for part in [data[i : i + block] for i in range(0, len(data), block)] + [b""]:
        squeezed = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = squeezed.compress(part) + squeezed.flush()
        out += b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


@pytest.mark.parametrize("step,block", [(64, 40), (97, 300), (500, 33), (1 << 20, 300)])
def test_block_gzip_in_ranges(spark, tmp_path, step, block):
    rng = random.Random(step)
    bodies = {"mixed": [rng.choice(["", "x" * rng.randrange(900), f"line {i}", "é\r"]) for i in range(120)], "one": ["y" * 3000], "none": [], "ends": ["a" * 39, "b" * 79, "c"]}
    for name, body in bodies.items():
        text = "".join(line + "\n" for line in body)
        for end in (text, text[:-1]):
            path = tmp_path / f"{name}.bgz"
            path.write_bytes(block_gzip(end.encode(), block))
            got = [r.value for r in blocks.read_lines(spark, [str(path)], step).collect()]
            expected = [line.removesuffix("\r") for line in end.split("\n")]
            assert got == (expected[:-1] if not expected[-1] else expected), (name, end is text)


def test_block_gzip_vcf(spark, tmp_path):
    text = "".join(line + "\n" for line in HEADER + LINES).encode()
    (tmp_path / "a.vcf").write_bytes(text)
    plain = calls_of(callset.import_vcf(spark, str(tmp_path / "a.vcf")).sites)
    # Any name will do; what counts is the content.
    for name in ("b.vcf.bgz", "c.vcf.gz"):
        (tmp_path / name).write_bytes(block_gzip(text, 70))
        data = callset.import_vcf(spark, str(tmp_path / name), range_bytes=128)
        assert calls_of(data.sites) == plain and data.sites.rdd.getNumPartitions() > 2
        assert {r.sample_id: r.sample_no for r in data.samples.collect()} == {"s1": 0, "s2": 1, "s3": 2}
    (tmp_path / "d.vcf.bgz").write_bytes(gzip.compress(text))
    with pytest.raises(ValueError, match="block-gzip"):
        read_vcf(spark, str(tmp_path / "d.vcf.bgz"))
    (tmp_path / "e.vcf.bgz").write_bytes(block_gzip(text)[:-40])
    with pytest.raises(Exception, match="no block at byte|Error"):
        read_vcf(spark, str(tmp_path / "e.vcf.bgz")).sites.collect()


def test_heads_stop_at_the_header(spark, tmp_path):
    """What lies behind the header is not looked at, not even when it is broken."""
    body = gzip.compress(("\n".join(HEADER) + "\n").encode()) + b"\x1f\x8b\x08 this is no gzip member"
    (tmp_path / "a.vcf.gz").write_bytes(body)
    (tmp_path / "empty.vcf.gz").write_bytes(gzip.compress(b"\n"))
    heads = {r.path.split("/")[-1]: r for r in blocks.read_heads(spark, [str(tmp_path / n) for n in ("a.vcf.gz", "empty.vcf.gz")], "#CHROM").collect()}
    assert heads["a.vcf.gz"].head == HEADER[1] and heads["empty.vcf.gz"].head is None and not heads["empty.vcf.gz"].filled


def _lines_per_file(glob_of):
    folder, pattern = glob_of.rsplit("/", 1)
    found = [f for d in Path(folder.removeprefix("file:")).glob(pattern) for f in d.glob("part-*")]
    return [(gzip.decompress(f.read_bytes()) if f.suffix == ".gz" else f.read_bytes()).decode().splitlines() for f in found]


def test_shards_grow_with_the_lines(spark, tmp_path, monkeypatch):
    """Every shard is a file with a header and about its share of the lines, also with a column per customer."""
    spark.range(600).selectExpr("CAST(id AS INT) AS p_partkey", "CAST(1 + id % 50 AS INT) AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(3).selectExpr("CAST(id AS INT) AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(40).selectExpr("CAST(id AS INT) AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(90).selectExpr("CAST(id AS INT) AS s_suppkey", "CAST(id % 3 AS INT) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(fx, "SHARD_LINES", 30)
    monkeypatch.setattr(fx, "SHARD_CELLS", 400)
    for glob_of, files, lines, head in ((fx.write_vcf(spark, str(tmp_path)), 20, 600, 2), (fx.write_wide_vcf(spark, str(tmp_path)), 9, 90, 1)):
        held = _lines_per_file(glob_of)
        assert len(held) == files and all(f[head - 1].startswith("#CHROM") for f in held)
        bodies = [[x for x in f if not x.startswith("#")] for f in held]
        assert sum(map(len, bodies)) == lines == len({x for b in bodies for x in b}) and max(map(len, bodies)) < 2.5 * lines / files


def test_wide_shards_are_few_and_packed(spark, tmp_path, monkeypatch):
    """Keys without a pattern: every line is there once, in gzip files that take far less than their text, few of them however many cells there are."""
    customers, suppliers = sorted(random.Random(5).sample(range(100_000), 400)), random.Random(6).sample(range(100_000), 200)
    spark.createDataFrame([(c,) for c in customers], "c_custkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(s, s % 25) for s in suppliers], "s_suppkey int, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(fx, "SHARD_CELLS", 100)
    glob_of = fx.write_wide_vcf(spark, str(tmp_path))
    most = fx.SHARDS_A_CORE * spark.sparkContext.defaultParallelism
    held = _lines_per_file(glob_of)
    head = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(map(str, customers))
    assert len(held) == most and all(f[0] == head for f in held)

    def line(s):
        cells = [fx.WIDE_GENOTYPES[(s + 3 * c) % 7] + (":LowGQ" if (s + c) % 5 == 0 else ":PASS") for c in customers]
        return "\t".join([f"chr{1 + s % 25 % 22}", str(10 + s), ".", "A", "C" if s % 2 else "G", "9", "PASS", ".", "GT:FT", *cells])

    assert sorted(x for f in held for x in f[1:]) == sorted(map(line, suppliers))
    folder = Path(glob_of.rsplit("/", 1)[0].removeprefix("file:"))
    assert 4 * sum(f.stat().st_size for f in folder.rglob("part-*")) < sum(len(x) + 1 for f in held for x in f)


def test_wide_shards_are_read_by_few_tasks(spark, tmp_path, monkeypatch):
    """Each task that reads sends its own counts of every sample, so tasks don't grow with the cells."""
    spark.range(40).selectExpr("CAST(id AS INT) AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(600).selectExpr("CAST(id AS INT) AS s_suppkey", "CAST(id % 25 AS INT) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(fx, "SHARD_CELLS", 40)
    data = read_vcf(spark, fx.write_wide_vcf(spark, str(tmp_path)))
    assert data.sites.rdd.getNumPartitions() <= fx.SHARDS_A_CORE * spark.sparkContext.defaultParallelism
    assert data.sites.select("pos").distinct().count() == 600 and data.samples.count() == 40


def test_samples_are_chosen_before_cells_are_read(spark, text_file):
    path = text_file("a.vcf", *HEADER, *LINES)
    wanted = spark.createDataFrame([("s3",), ("s1",), ("s1",), ("elsewhere",)], "sample_id string")
    data = read_vcf(spark, path, keep_samples=wanted)
    assert {r.sample_id: r.sample_no for r in data.samples.collect()} == {"s1": 0, "s3": 2}
    assert {c.sample_id for r in data.sites.collect() for c in r.calls} == {"s1", "s3"}
    nobody = read_vcf(spark, path, keep_samples=wanted.limit(0))
    assert nobody.samples.count() == 0 and {len(r.calls) for r in nobody.sites.collect()} == {0}


def test_sample_filter_runs_inside_the_array(spark):
    """200 samples, some beyond the first word; no row is made of an unwanted call, so nothing filters or joins above the explode."""
    names = [f"s{i}" for i in range(200)]
    samples = spark.createDataFrame(list(enumerate(names)), "sample_no int, sample_id string")
    wanted = spark.createDataFrame([(n,) for n in names[::7]], "sample_id string")
    calls = "transform(sequence(0, 199), i -> named_struct('sample_no', i, 'sample_id', concat('s', i), 'a1', 0, 'a2', i % 3, 'ft', cast(null as string)))"
    sites = spark.range(3).selectExpr("'c' AS contig", "int(id) AS pos", f"{calls} AS calls")
    exploded = call_ops.explode_carriers(sites, wanted=wanted_words(samples, wanted))
    got = exploded.groupBy("sample_id").count().collect()
    assert {r.sample_id: r["count"] for r in got} == {n: 3 for i, n in enumerate(names) if i % 7 == 0 and i % 3}
    plan = exploded._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate explode")]
    assert "Join" not in above and "Filter" not in above


def test_cached_scan_prunes(spark, text_file, tmp_path):
    cache = str(tmp_path / "cache")
    data = callset.cached_import(spark, text_file("a.vcf", *HEADER, *LINES), cache)
    spans = spark.createDataFrame([("S", "chr1", 150, 250)], "set_name string, contig string, start int, end int")
    kept = callset.in_span(data, spans).sites
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = kept.select("contig", "pos", "calls.sample_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(pos,150)" in plan and "af:" not in plan.split("ReadSchema")[1].splitlines()[0]
    assert kept.count() == 2
    assert callset.in_span(data, spans, broadcast_contigs=0).sites.count() == 2
    many = spark.range(40).selectExpr("'S' AS set_name", "concat('chr', id) AS contig", "150 AS start", "250 AS end")
    assert callset.in_span(data, many).sites.count() == 2
    assert callset.in_span(data, spans.limit(0)).sites.count() == 0


def test_zone_map_picks_files(spark, tmp_path):
    call = "array(named_struct('sample_no', 0, 'sample_id', 'a', 'a1', 0, 'a2', 1, 'ft', cast(null as string)))"
    sites = spark.range(20_000).selectExpr(
        "concat('chr', 1 + id % 2) AS contig", "int(id * 10000) AS pos", "'A' AS ref", "'G' AS alt",
        "cast(null as array<string>) AS filters", "cast(null as array<double>) AS af", "cast(null as array<int>) AS ac",
        f"if(id % 3 = 0, {call}, null) AS calls")
    samples = spark.createDataFrame([(0, "a")], "sample_no int, sample_id string")
    path = str(tmp_path / "c")
    callset.write_callset(Callset(sites, samples), path, range_partitions=20)
    stored = callset.read_callset(spark, path)
    table = spark.read.parquet(f"{path}/zones")
    assert table.agg(F.sum("sites"), F.sum("calls")).first() == (20_000, 6_667)

    # Two sets at the two ends of one contig: what lies between is not read.
    far = spark.createDataFrame(
        [("A", "chr1", 5, 90_000), ("B", "chr1", 199_000_000, 199_990_000), ("B", "chr2", 9, 3), ("C", "chrX", 1, 9)],
        "set_name string, contig string, start int, end int")
    near = callset.in_span(stored, far).sites
    files_read = len(near.inputFiles())
    assert 1 <= files_read <= 4 < len(stored.sites.inputFiles()) == 20
    inside = F.expr("contig = 'chr1' and (pos between 5 and 90000 or pos between 199000000 and 199990000)")
    assert rows_of(near.filter(inside).select("contig", "pos")) == rows_of(sites.filter(inside).select("contig", "pos"))
    assert zones.read_near(spark, path, far.filter("set_name = 'C'")).count() == 0
    # Narrow cells change cost alone; bounds over several cells are found.
    wide = spark.createDataFrame([("A", "chr2", 1, 150_000_000)], far.schema)
    for cell_bp in (1 << 16, zones.CELL_BP, 1 << 31):
        assert zones.read_near(spark, path, wide, cell_bp).filter("contig = 'chr2' and pos <= 150000000").count() == 7_500

    # A file that the map does not know is read.
    sites.limit(1).write.mode("append").parquet(f"{path}/sites")
    assert len(zones.read_near(spark, path, far).inputFiles()) == files_read + 1


def test_stale_imports_are_listed(spark, text_file, tmp_path):
    source, cache = text_file("a.vcf", *HEADER, *LINES), str(tmp_path / "cache")
    first = callset.cached_import(spark, source, cache)
    assert callset.stale_imports(spark, cache) == []
    second = callset.cached_import(spark, source, cache, force=True)
    assert callset.stale_imports(spark, cache) == [first.folder] and second.folder != first.folder


def test_callset_sorted_by_range(spark, text_file, tmp_path):
    data = callset.import_vcf(spark, text_file("a.vcf", *HEADER, *LINES))
    callset.write_callset(Callset(data.sites, data.samples), str(tmp_path / "c"), range_partitions=2)
    assert callset.read_callset(spark, str(tmp_path / "c")).sites.count() == 4


def test_bed_and_interval_list(spark, text_file):
    bed = text_file("x.bed", "# c", "chr1\t10\t20\tname", "chr1\t15\t25", "chr1\t30\t30", "chr1\t40\t35", "chrUn_x\t1\t5")
    assert sorted(tuple(r) for r in intervals.read_sites(spark, bed).collect()) == [
        ("chr1", 11, 20), ("chr1", 16, 25), ("chrUn_x", 2, 5)]
    tool = intervals.read_bed(spark, bed).collect()
    assert sorted((r.start0, r.width, r.chrom_order) for r in tool) == [(10, 10, 1), (15, 10, 1), (30, 0, 1), (40, -5, 1)]
    listed = text_file("x.interval_list", "@HD\tVN:1", "chr1\t10\t20\t+\tn")
    assert [tuple(r) for r in intervals.read_sites(spark, listed).collect()] == [("chr1", 10, 20)]


def test_named_sets(spark, text_file, tmp_path):
    a = text_file("GRCh38_gc85_slop50.bed", "chr1\t1\t2")
    text_file("other.bed", "chr2\t1\t2")
    text_file("other_downsampled.bed", "chr2\t1\t2")
    text_file("notes.txt", "x")
    found = intervals.discover_beds(spark, str(tmp_path))
    assert sorted(found) == ["GC_gt_85", "other"]
    assert intervals.parse_specs(["A=x=y", "B=z"]) == {"A": "x=y", "B": "z"}
    with pytest.raises(ValueError):
        intervals.parse_specs(["nothing"])
    sets = {"here": a, "gone": str(tmp_path / "gone.bed")}
    with pytest.raises(FileNotFoundError, match="gone"):
        intervals.read_site_sets(spark, sets)
    assert [r.set_name for r in intervals.read_site_sets(spark, sets, "skip").collect()] == ["here"]
    broken = {"here": a, "broken": text_file("broken.bed", "chr1\tone\t2"), "some": str(tmp_path / "oth*.bed")}
    assert sorted(r.set_name for r in intervals.read_site_sets(spark, broken, "skip").collect()) == ["here", "some", "some"]


def test_labels_keep_text_ids(spark, text_file):
    a = text_file("a.tsv", "research_id\tancestry_pred_other\textra", "007\teur\tx", "8\tafr\ty", "8\tafr\tz")
    g = text_file("g.tsv", "research_id\tsite", "007\tA", "9\tB", "8\t")
    anc, grp = labels.read_ancestry(spark, a), labels.read_groups(spark, g, "site")
    assert sorted((r.sample_id, r.ancestry) for r in anc.collect()) == [("007", "eur"), ("8", "afr"), ("8", "afr")]
    assert {(r.sample_id, r.grp) for r in grp.collect()} == {("007", "A"), ("9", "B"), ("8", None)}
    odd = text_file("m.tsv", "research_id\tsite", "NA\tA", "2\tNA", "3\tnull", "4\tNaN", "5\tNAB")
    assert {(r.sample_id, r.grp) for r in labels.read_groups(spark, odd, "site").collect()} == {("NA", "A"), ("2", None), ("3", None), ("4", None), ("5", "NAB")}


def test_results_need_columns(spark, text_file, tmp_path):
    text_file("pairwise_comparisons.tsv", "group_x\tmetric", "A\tm")
    with pytest.raises(ValueError, match="comparison"):
        results.read_results(spark, str(tmp_path))


def test_results_without_sample_table(spark, text_file, tmp_path):
    text_file("pairwise_comparisons.tsv", "comparison\tgroup_x\tgroup_y\tmetric\tn_x\tn_y\tcohens_d\tp_value",
              "site\tA\tB\tS_snp_total\t60\t70\t0.61\t", "site\tA\tB\tS_titv_total\t60\t70\tnan\t0.2")
    text_file("group_summaries.tsv", "ancestry\tsite\tGC_gt_85_snp_total_mean\tGC_gt_85_snp_total_std\tGC_gt_85_snp_total_count",
              "eur\tA\t3.5\t\t60")
    data = results.read_results(spark, str(tmp_path))
    assert data.sample_stats is None and data.comparison_name == "site"
    rows = {r.metric: r for r in data.comparisons.collect()}
    assert rows["S_snp_total"].cohens_d == 0.61 and rows["S_snp_total"].p_value is None and rows["S_snp_total"].n_x == 60
    assert rows["S_titv_total"].cohens_d is None and rows["S_titv_total"].ancestry == "all"
    row = results.long_summaries(data.group_summaries, "site").first()
    assert (row.set_name, row.metric_type, row["mean"], row["std"], row["count"]) == ("GC_gt_85", "snp_total", 3.5, None, 60)
    assert files.exists(spark, str(tmp_path)) and not files.exists(spark, str(tmp_path / "nope"))
