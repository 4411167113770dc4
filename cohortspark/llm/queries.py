"""One query per operator over its whole table, and the SQL beside it where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm import decontam, exact, langid, lines, mixing, packing, pii, runs, search, sharding, simhash, suffix, warc
from cohortspark.llm.common import text_of
from cohortspark.shared import shared_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(column: str) -> F.Column:
    return F.sha2(F.col(column).cast("binary"), 256)


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.sanitise(docs, clean=False)
    terms = F.transform("term_spans", lambda s: F.struct(s["start"].alias("start"), F.lit(4).alias("kind"), s["end"].alias("end")))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(pii.span_text(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        pii.span_text(F.concat("base_spans", terms)).alias("spans"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.decontaminate(docs, _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The digest table of the operator is all that is left of the texts before anything is shuffled.
    docs = exact.with_digests(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return exact.resolve(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text_of("text")).cast("bigint") + 16).alias("size"),
        F.crc32(text_of("text").cast("binary")).alias("text_crc32"), "lang", "source",
    )
    return sharding.hilbert_shards(rows, ["lang", "source", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.line_dedup(docs).select("doc_id", "n_lines", "n_dropped", _sha256("kept_text").alias("kept_sha256"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", _sha256("kept").alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def held_out(key: str = "doc_id") -> F.Column:
    """A third of the documents is never learned from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~held_out()))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = shared_path(spark, "warc")
    warc.write_archives(pages, path)
    records = warc.read_records(warc.index_archives(spark, path))
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))


def with_planted_periods(key: str = "doc_id", text: str = "text") -> F.Column:
    """The text; in a tenth of the documents, chosen by id, the words from some place on repeat with a period."""
    hashed = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(hashed / 10).cast("bigint")
    words = F.filter(F.split(text_of(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    start = (g % F.nullif(n, F.lit(0))).cast("int")
    period = (F.floor((n - start) / (g % 8 + 3)) + 1).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, start + 1, period), F.ceil((n - start) / period).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), start), again), F.lit(1), n), " ")
    return F.when(hashed % 10 == 0, F.coalesce(planted, text_of(text))).otherwise(text_of(text))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", with_planted_periods().alias("text"))
    best = F.get(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("by"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(0))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    found = runs.periodic_runs(docs).select("doc_id", "runs", "collapsed_text", best.alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.by")).alias("length"), F.col("best.period").alias("period"),
        F.call_function("div", F.col("best.by") * -1000, F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit("")).cast("binary"), 256).alias("runs_sha256"),
        _sha256("collapsed_text").alias("collapsed_sha256"),
    )


#: Weights of documents labelled good, labelled bad, and not labelled.
QUALITY = (2.0, 0.5, 1.0)


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad, unknown = map(F.lit, QUALITY)
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("size"), F.xxhash64(text_of("text")).alias("content"))
    rated = docs.join(labels, "doc_id", "left").withColumn("quality", F.when(F.col("quality") > 0, good).when(F.col("quality") == 0, bad).otherwise(unknown))
    return mixing.mix(rated, quality="quality", content="content").select("doc_id", "size", "source_size", "target", "taken")


REGISTRY = {f.__name__: f for f in (op1_packing, op2_personal_data, op3_decontamination, op4_suffix_dedup, op5_exact_dedup, op6_simhash, op7_language_id, op8_hilbert_shards, op9_line_dedup, op10_warc, op11_ranked_search, op12_periodic_runs, op13_source_mix)}

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op4_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, unnest(range(0, len(h) // 2 - 199)) AS pos, h FROM d WHERE len(h) >= 400),
w AS (SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 400)) AS win FROM s),
r AS (SELECT doc_id, pos FROM w JOIN (SELECT win FROM w GROUP BY win HAVING count(*) > 1) USING (win)),
g AS (SELECT *, CASE WHEN pos <= lag(pos) OVER o + 200 THEN 0 ELSE 1 END AS fresh FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM g),
p AS (SELECT doc_id, span, min(pos) AS a, max(pos) + 200 AS b FROM n GROUP BY ALL),
k AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM p),
t AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head, max(b) AS last
      FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)""",
    "op3_decontamination": rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS win, least(len(w), 10) AS n
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
placed AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, placed.n, item_id FROM placed JOIN win ON placed.win = win.win AND placed.n = win.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op5_exact_dedup": rf"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       first_value(doc_id) OVER w = doc_id AS kept, sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id)""",
    "op9_line_dedup": rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id""",
    "op10_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h, coalesce(html, '') AS body FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, 5 * (i // 4)::INT + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f""",
    "op11_ranked_search": rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest(list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term FROM benchmark),
whole AS (SELECT count(*)::BIGINT AS nd, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY term, nd),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l))))::BIGINT AS score
      FROM q JOIN df USING (term) JOIN tf USING (term), whole GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 50""",
}
