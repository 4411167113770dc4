"""Packing, language identification, sharding, WARC archives and the pipeline."""

import base64
import gzip
import hashlib
import itertools
import json
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cohortspark.llm import decontam, langid, packing, queries, sharding, simhash, warc
from cohortspark.shared import shared_path

SF_DIR = "/root/testdata/sf0.001"


# --- packing ------------------------------------------------------------------------------


def whole_ids(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t.encode(text, add_special_tokens=False).ids


def test_words_are_cut_where_the_tokenizer_cuts():
    rng = random.Random(1)
    pieces = ["the", "it's", "  ", " ", "\n", "\t", "é", "42", "...", " ", " ", "a_b", "<|endoftext|>", "'ll", "日本", "\x1c", "\r\n"]
    encoder = packing._Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randrange(40))) for _ in range(400)] + [""]
    assert encoder.fast is not None
    slow = packing._Encoder.__new__(packing._Encoder)
    slow.fast, slow.tokenizer = None, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text, ids, same in zip(texts, encoder.encode(texts), slow.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole_ids(text), text
        assert ids == same


def test_other_vocabularies_go_to_the_tokenizer():
    spec = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    assert packing._byte_level(spec) is not None
    for part, key, value in (("pre_tokenizer", "add_prefix_space", True), ("model", "ignore_merges", True), ("model", "merges", spec["model"]["merges"][::-1])):
        assert packing._byte_level(spec | {part: spec[part] | {key: value}}) is None
    assert packing._byte_level(spec | {"normalizer": {"type": "NFC"}}) is None


def test_every_character_has_the_ids_of_the_tokenizer():
    """Letters, numbers and spaces are the same to both, whatever their Unicode tables."""
    encoder = packing._Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    points = [c for c in range(0x32000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 500):
        text = "".join(f"x{chr(c)}y 1{chr(c)}2 {chr(c)}{chr(c)} .{chr(c)}\n" for c in points[k : k + 500])
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("sizes", [[5], [1024] * 3, [700] * 9, list(range(1, 300)), [600, 500, 400, 300, 200, 100] * 20])
def test_blocks_fit_and_are_near_equal(sizes):
    sizes = np.array(sizes)
    owner = packing.pack_block(sizes)
    loads = np.bincount(owner, weights=sizes)
    assert loads.max() <= 1024 and len(owner) == len(sizes) and (loads > 0).all()


def test_differencing_balances():
    sizes = np.random.default_rng(2).integers(1, 256, 2000)
    loads = np.bincount(packing.difference(sizes, 300), weights=sizes)
    assert len(loads) == 300 and loads.max() - loads.min() <= 32


def test_packing_round_trip(spark):
    rng = random.Random(3)
    texts = [None, "", "a", "word " * 6000, "same text"] + [" ".join(f"w{rng.randrange(999)}" for _ in range(rng.randrange(900))) for _ in range(120)] + ["same text"]
    docs = spark.createDataFrame([(i, t, "c", "d") for i, t in enumerate(texts)], "doc_id bigint, text string, start string, length string").repartition(3)
    rows = packing.pack(docs).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        own = sorted(by_doc[i], key=lambda r: r.start)
        ids = np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist()
        assert ids == whole_ids(text or "") + [0] and all(r.doc_tokens == len(ids) for r in own)
        assert [r.start for r in own] == list(itertools.accumulate([0] + [r.length for r in own[:-1]]))
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(itertools.accumulate([0] + [r.length for r in own[:-1]])) and sum(r.length for r in own) <= 1024
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= total / 1024 * 1.03 + 3
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_query_digests(spark):
    rows = queries.op1_packing(spark, SF_DIR).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in rows[::97]:
        ids = np.array((whole_ids(text[r.doc_id]) + [0])[r.start : r.start + r.length], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32


# --- language -----------------------------------------------------------------------------


def test_codewords_are_apart():
    for k in (2, 3, 4, 6, 12, 40):
        code = langid.codewords(k)
        least = min((code[i] != code[j]).sum() for i in range(k) for j in range(i))
        assert least >= (1 if k == 2 else 2) and (k <= 7 or least >= code.shape[1] // 4)


def test_language_accuracy_on_held_out_documents(spark):
    rows = queries.op7_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def plain_buckets(text):
    """The trigram buckets of a text, one at a time."""
    data = b" " + text.lower().encode("utf-8", "replace") + b" "
    folded = [c if c >= 128 or 97 <= c <= 122 else 32 for c in data]
    return [((a << 16 | b << 8 | c) * 2654435761) % 2**32 >> 17 for a, b, c in zip(folded, folded[1:], folded[2:])]


def plain_decoder(labelled, code):
    """Bit classifiers and loss-weighted decoding of the languages of ``labelled``, in loops over dictionaries."""
    languages = sorted({lang for _, lang in labelled})
    counts = {lang: {} for lang in languages}
    for text, lang in labelled:
        for b in plain_buckets(text):
            counts[lang][b] = counts[lang].get(b, 0) + 1
    whole = {lang: sum(c.values()) + 0.5 * langid.BUCKETS for lang, c in counts.items()}
    share = lambda lang, b: (counts[lang].get(b, 0) + 0.5) / whole[lang]
    bits = range(len(code[0]))

    def weight(b, j):
        ones = [share(lang, b) for lang, word in zip(languages, code) if word[j] > 0]
        zeros = [share(lang, b) for lang, word in zip(languages, code) if word[j] < 0]
        return math.log(sum(ones) / len(ones)) - math.log(sum(zeros) / len(zeros))

    table = [[weight(b, j) for j in bits] for b in range(langid.BUCKETS)]
    margins = [[word[j] * sum(share(lang, b) * table[b][j] for b in range(langid.BUCKETS)) for j in bits] for lang, word in zip(languages, code)]
    scale = [sum(abs(m[j]) for m in margins) / len(languages) for j in bits]
    trust = [max(min(m[j] / scale[j] for m in margins), 0.05) for j in bits]

    def decide(text):
        found = plain_buckets(text)
        margin = [sum(table[b][j] for b in found) / len(found) / scale[j] for j in bits]
        losses = [sum(trust[j] * math.exp(min(max(-word[j] * margin[j], -8), 8)) for j in bits) / sum(trust) for word in code]
        best = min(losses)
        second = sorted(losses)[1]
        return languages[losses.index(best)], 1 / sum(math.exp(-4 * (x - best)) for x in losses), second - best

    return decide


def test_languages_against_brute_force(spark):
    """Language, score and ambiguity of every document are those of a decoder that counts one trigram after another."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    learn = docs.filter("doc_id % 2 = 0 AND lang IS NOT NULL AND text IS NOT NULL")
    model = langid.train(learn)
    got = langid.identify(docs, model).collect()
    pairs = [(r.text, r.lang) for r in learn.collect()]
    decide = plain_decoder(pairs, langid.codewords(len({lang for _, lang in pairs})).tolist())
    for r in got:
        if r.text is None or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        lang, score, gap = decide(r.text)
        assert r.lang_pred == lang and math.isclose(r.score, score, abs_tol=1e-4)
        assert r.ambiguous == (gap < 0.1) or abs(gap - 0.1) < 1e-4


def test_language_edges(spark):
    schema = "doc_id bigint, text string, lang string, score string, ambiguous string"
    learn = spark.createDataFrame([(1, "the cat sat on the mat with the hat", "en", "", ""), (2, "der hund und die katze sind nicht hier", "de", "", ""), (3, None, "fr", "", ""), (4, "x", None, "", "")], schema)
    long_text = "the hat and the cat " * 200_000
    ask = spark.createDataFrame([(None, None, None, "", ""), (5, "", None, "", ""), (6, "123 ... \n", None, "", ""), (9, "½ ² Ⅷ ①", None, "", ""), (7, "der hund und die katze", None, "", ""), (8, long_text, None, "", ""), (7, "der hund und die katze", None, "", "")], schema)
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in langid.identify(ask, langid.train(learn)).collect()}
    assert got[(None, None)] == got[(5, "")] == got[(6, "123 ... \n")] == got[(9, "½ ² Ⅷ ①")] == ("und", 0.0)
    assert got[(7, "der hund und die katze")][0] == "de" and got[(8, long_text)][0] == "en"
    nothing = langid.train(learn.filter("lang IS NULL"))
    assert nothing is None and {r.lang_pred for r in langid.identify(ask, nothing).collect()} == {"und"}
    one = langid.train(learn.filter("lang = 'en'"))
    assert {r.lang_pred for r in langid.identify(ask, one).collect()} == {"en", "und"}
    assert langid.identify(ask.limit(0), one).count() == 0


def test_long_texts_score_the_same_in_slices(monkeypatch):
    texts = ["abc def ghi " * 500, "", "jkl"]
    weights = np.random.default_rng(1).random((langid.BUCKETS, 3))

    def sums():
        out = np.zeros((3, 3))
        for index, grams, starts in langid._slices(texts):
            np.add.at(out, index, langid._sums(weights[grams], starts))
        return out

    whole = sums()
    monkeypatch.setattr(langid, "_SLICE", 777)
    assert np.allclose(sums(), whole)


# --- sharding -----------------------------------------------------------------------------


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2), (2, 1), (1, 3)])
def test_hilbert_curve_visits_neighbours(spark, dims, bits):
    cells = spark.createDataFrame(list(itertools.product(range(2**bits), repeat=dims)), ", ".join(f"q{i} int" for i in range(dims)))
    rows = sorted(cells.select("*", sharding.hilbert_index([F.col(f"q{i}") for i in range(dims)], bits).alias("h")).collect(), key=lambda r: r.h)
    assert [r.h for r in rows] == list(range(len(rows)))
    assert all(sum(abs(a[i] - b[i]) for i in range(dims)) == 1 for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("n", [0, 1, 39, 40, 1001, 5000])
def test_shards_are_gapless_and_equal(spark, n):
    rows = spark.range(n).selectExpr(
        "CASE WHEN id % 10 = 0 THEN NULL ELSE id DIV 2 END AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('s', id % 20) END AS source",
        "CAST(id * id % 977 AS BIGINT) AS size", "'x' AS shard")
    got = sharding.hilbert_shards(rows, ["source", "size"], shards=40, bucket_rows=200).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert len(got) == n and all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by.get(s, [])) for s in range(40)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and set(by) <= set(range(40))


def plain_hilbert(point, bits):
    """Index of a cell by the published transpose algorithm, one cell at a time."""
    x, top = list(point), 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(len(x)):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    t, q = 0, top
    while q > 1:
        if x[-1] & q:
            t ^= q - 1
        q >>= 1
    return int("".join(str((v ^ t) >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def plain_levels(values, levels):
    known = sorted(v for v in values if v is not None)
    edges = {known[-(-k * len(known) // levels) - 1] for k in range(1, levels)} if known else set()
    return [0 if v is None else sum(v >= e for e in edges) for v in values]


@pytest.mark.parametrize("seed", [1, 2])
def test_shards_against_brute_force(spark, seed):
    """Every shard and slot from levels, curve and runs recomputed in plain Python; strings differ late and one is far away."""
    rng = random.Random(seed)
    urls = [f"https://example.org/archive/{rng.randrange(10**6):06d}" for _ in range(400)] + ["zzz", "", "é", None]
    data = [(i, rng.choice(urls) if rng.random() < 0.7 else "https://example.org/hot", rng.choice([None, *range(50)]), rng.randrange(10**6)) for i in range(1_500)]
    df = spark.createDataFrame(data, "doc_id bigint, url string, a int, b bigint").repartition(5)
    got = sharding.hilbert_shards(df, ["url", "a", "b"], shards=7)
    levels = list(zip(*[plain_levels([r[k] for r in data], 16) for k in (1, 2, 3)]))
    assert len({q[0] for q in levels}) >= 10  # the outlier does not take the levels of the others
    order = sorted(range(len(data)), key=lambda i: (plain_hilbert(levels[i], 4), i))
    want = {}
    for rank, i in enumerate(order):  # 1,500 rows in 7 shards: two of 215, five of 214
        shard = rank // 215 if rank < 430 else 2 + (rank - 430) // 214
        want[i] = (shard, rank - (shard * 215 if shard < 2 else 430 + (shard - 2) * 214))
    assert {r.doc_id: (r.shard, r.slot) for r in got.collect()} == want


def test_string_levels_of_few_or_no_values(spark):
    schema = "doc_id bigint, s string"
    assert sharding._text_cuts(spark.createDataFrame([], schema), "s", 16) == []
    assert sharding._text_cuts(spark.createDataFrame([(1, None), (2, None)], schema), "s", 16) == []
    assert sharding._text_cuts(spark.createDataFrame([(i, "same") for i in range(50)], schema), "s", 16) == ["same"]
    assert sorted(sharding._text_cuts(spark.createDataFrame([(i, "ab"[i % 2]) for i in range(50)], schema), "s", 2)) == ["a"]


def test_shards_prune(spark):
    """A shard covers a small part of every dimension."""
    rows = spark.range(20_000).selectExpr("id AS doc_id", "CAST(pmod(xxhash64(id), 1000) AS BIGINT) AS a", "CAST(pmod(xxhash64(id, 1), 1000) AS BIGINT) AS b")
    got = sharding.hilbert_shards(rows, ["a", "b"], shards=64)
    spans = got.groupBy("shard").agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")).collect()
    assert np.mean([r.a for r in spans]) < 300 and np.mean([r.b for r in spans]) < 300
    path = shared_path(spark, "shards")
    sharding.write_shards(got, path)
    assert spark.read.parquet(path).count() == 20_000 and "shard=63" in {p.rsplit("/", 2)[1] for p in spark.read.parquet(path).inputFiles()}


# --- archives -----------------------------------------------------------------------------


def test_archives_round_trip(spark):
    pages = [(i, f"http://x.example/{i}", f"<p>{i % 5}</p>\r\n\r\n<b>é</b>" if i % 3 else "<p>hot</p>") for i in range(60)]
    pages += [(100, None, None), (101, "http://a\r\nb", ""), (102, "u", "y" * 300_000), (None, "n", "only here"), (None, "n", "<p>hot</p>"), (7, "http://x.example/7", pages[7][2])]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id bigint, url string, html string, record_type string").repartition(4)
    path = shared_path(spark, "warc")
    warc.write_archives(df, path)
    index = warc.index_archives(spark, path)
    got = warc.read_records(index, read_bytes=1000).collect()
    assert len(got) == len(pages) and not index.filter("url LIKE '%\n%'").count()
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    expected = []
    for i, _, h in pages:
        data = (h or "").encode()
        lead = first.get(h or "")
        revisit = lead is not None and lead != i
        expected.append((str(i) if i is not None else None, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
                         str(lead) if revisit else None, None if revisit else data))
    assert sorted(map(str, expected)) == sorted(str((r.record_id, r.payload_bytes, r.digest, r.record_type, r.refers_to, bytes(r.payload) if r.payload is not None else None)) for r in got)
    some = warc.read_records(index.filter("record_id = '102'")).collect()
    assert [bytes(r.payload) for r in some] == [b"y" * 300_000]
    files = [r.value for r in spark.read.text(path, wholetext=True).collect()]
    assert all(f.startswith("WARC/1.1\r\n") and f.endswith("\r\n\r\n") for f in files if f)


def foreign_records():
    """Records as other programs write them: kind, id, further lines, block."""
    page = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>one</p>\r\n\r\n<p>two</p>"
    digest = base64.b32encode(hashlib.sha1(b"<p>one</p>\r\n\r\n<p>two</p>").digest()).decode()
    return [
        ("warcinfo", "<urn:uuid:1>", ["Content-Type: application/warc-fields"], b"software: x\r\n"), ("request", "<urn:uuid:2>", ["WARC-Target-URI: http://a/"], b"GET / HTTP/1.1\r\nHost: a\r\n\r\n"),
        ("response", "<urn:uuid:3>", ["WARC-Target-URI: http://a/", f"WARC-Payload-Digest: sha1:{digest}"], page), ("response", "<urn:uuid:4>", ["WARC-Target-URI:http://b/"], page),
        ("response", "<urn:uuid:5>", ["WARC-Payload-Digest: sha256:abc"], b"HTTP/1.1 204 No Content\r\n\r\n"), ("resource", "<urn:uuid:6>", [], b"x" * 70_000),
        ("metadata", "<urn:uuid:7>", [], b""), ("revisit", "<urn:uuid:8>", ["WARC-Refers-To: <urn:uuid:3>"], b"HTTP/1.1 304 Not Modified\r\n\r\n"),
    ], digest


@pytest.mark.parametrize("packed", [False, True])
def test_archives_of_other_writers(spark, tmp_path, packed):
    records, digest = foreign_records()
    body = b""
    for kind, mark, more, block in records:
        head = "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {mark}", *more, f"Content-Length: {len(block)}"])
        record = head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
        body += gzip.compress(record) if packed else record + (b"\r\n" if kind == "request" else b"")
    (tmp_path / ("a.warc.gz" if packed else "a.warc")).write_bytes(body)
    index = warc.index_archives(spark, str(tmp_path))
    assert [r.record_type for r in index.orderBy("offset").collect()] == [r[0] for r in records]
    got = {r.record_id: r for r in warc.read_records(index, read_bytes=200).collect()}
    page = b"<p>one</p>\r\n\r\n<p>two</p>"
    assert {i.removeprefix("urn:uuid:"): r.payload and bytes(r.payload) for i, r in got.items()} == {
        "1": None, "2": None, "3": page, "4": page, "5": b"", "6": b"x" * 70_000, "7": None, "8": None}
    assert got["urn:uuid:3"].digest == digest and got["urn:uuid:4"].digest is None and got["urn:uuid:4"].payload_bytes == len(page)
    assert got["urn:uuid:4"].url == "http://b/" and got["urn:uuid:8"].refers_to == "urn:uuid:3" and got["urn:uuid:8"].payload_bytes is None
    (tmp_path / "broken.warc").write_bytes(b"no archive at all\r\n\r\n")
    with pytest.raises(Exception, match="no record at byte 0"):
        warc.index_archives(spark, str(tmp_path))


def test_payloads_must_match_their_digest(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\n\r\nother"
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha1:{'A' * 32}\r\nContent-Length: {len(block)}\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(head.encode() + block + b"\r\n\r\n")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_records(warc.index_archives(spark, str(tmp_path))).collect()


def test_archives_small_payloads_are_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long page"), (4, "u", "long page")], "page_id bigint, url string, html string")
    got = {r.id: r.record_type for r in warc.with_types(df, min_revisit_bytes=5).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_no_pages(spark):
    path = shared_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert warc.read_records(warc.index_archives(spark, path)).count() == 0


# --- pipeline -----------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    extra = [(1000, None), (1001, "123 456"), (1002, rows[3].text), (1003, rows[3].text.replace(" ", "  ") + " ")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, None, None, None) for i, t in extra], docs.schema))
    kept = docs
    texts = {**{i: r.text for i, r in rows.items()}, **dict(extra)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == docs.columns, name
        if name == "language_id":
            ids = {r.doc_id for r in kept.collect()}
            assert ids == set(texts) - {1000, 1001}
        elif name == "exact_dedup":
            groups = {}
            for i in ids:
                groups.setdefault("".join(texts[i].split()), []).append((-len(texts[i]), i))
            ids = {min(g)[1] for g in groups.values()}
            assert {r.doc_id for r in kept.collect()} == ids and 1003 in ids and 3 not in ids
        elif name == "near_dedup":
            fps = {i: np.uint64(simhash.fingerprint(texts[i].encode())) for i in ids}
            left = {r.doc_id for r in kept.collect()}
            gone = ids - left
            assert all(min(int(np.bitwise_count(fps[i] ^ fps[j])) for j in ids if j != i) <= 3 for i in gone)
            assert all(int(np.bitwise_count(fps[i] ^ fps[j])) > 3 for i, j in itertools.combinations(sorted(left), 2))
            ids = left
        else:
            bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
            bad = {r.doc_id for r in decontam.decontaminate(docs.select("doc_id", "text"), bench).filter("contaminated").collect()}
            assert {r.doc_id for r in kept.collect()} == ids - bad and ids & bad
            ids -= bad
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR).collect()
    assert {r.doc_id for r in packed} == ids
    for i in sorted(ids)[:20]:
        own = sorted((r for r in packed if r.doc_id == i), key=lambda r: r.start)
        assert np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist() == whole_ids(texts[i]) + [0]


def test_pipeline_without_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0).withColumn("kept", F.lit(1)).withColumn("n_words", F.lit(2))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.count() == 0
        if name != "packing":
            assert out.columns == docs.columns
