"""Exact, line, near and suffix deduplication, decontamination and personal data against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortspark.llm import bitmap, common, decontam, exact, lines, pii, simhash, suffix
from cohortspark.llm import queries as llm_queries
from cohortspark.llm.components import connected_components

SCHEMA = "doc_id bigint, text string, lang string, kept string, group_size string, n_hit string, spans string"
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of rare herbs under the old bridge"


def make(spark, texts, ids=None):
    """Documents with extra columns named like operators' outputs."""
    rows = [(i if ids is None else ids[i], t, None, "x", None, "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def edge_texts():
    rng = random.Random(5)
    words = PROSE.split()
    long_text = " ".join(rng.choice(words) for _ in range(20_000))
    return [
        None, "", " \t\n\r", PROSE, PROSE.upper(), PROSE + " ", PROSE.replace(" ", "  "), PROSE, long_text, long_text + " end", "é ß Ñ", "É ß Ñ",
        "a", "a\nb\n", "\n\n", "x\x0by\x0cz", "one two", "line one\nLine ONE \nline two",
    ]


# --- helpers ------------------------------------------------------------------------------


@pytest.mark.parametrize("total", [10, 40_000])
def test_lookup_with_hot_keys(spark, total):
    rows = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 50 AS STRING) END AS k")
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("k <> '7'")
    got = common.lookup(rows, facts, ["k"], "n", total, F.col("id")).groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n")).collect()
    assert all(r.n == r.c for r in got if r.k != "7") and [r.n for r in got if r.k == "7"] == [None]
    assert len(got) == 51


def test_lookup_deals_hot_rows_out(spark):
    """The scattered key stays in the join, so that rows of a hot key land in many partitions."""
    rows = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k")
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plan = common.lookup(rows, facts, ["k"], "n", 30_000, F.col("id"))._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join LeftOuter" in line and "rightHint" not in line)
    assert join.count("_scatter") == 2


@pytest.mark.parametrize("twice", [False, True])
def test_bitmap(spark, twice):
    values = [random.Random(1).getrandbits(63) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values + values[:700] + values[:100]], "h bigint").repartition(4)
    size = bitmap.size_for(3800)
    bits = bitmap.build(df, size, twice=twice)
    found = {r.h for r in df.filter(bitmap.hit(bits, size, F.col("h"))).collect()}
    assert set(values[:700]) <= found and (len(found) < 1000 if twice else found == set(values))


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 2000 + i) for i in range(200)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.component for r in got.collect()} == {n: root(n) for n in parent}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- exact copies -------------------------------------------------------------------------


def test_exact_against_brute_force(spark):
    texts = edge_texts() + ["same"] * 40
    ids = [*range(len(texts) - 2), None, 20]  # a null id and a repeated row
    got = exact.exact_dedup(make(spark, texts, ids)).collect()
    assert len(got) == len(texts)
    groups = {}
    for i, t in zip(ids, texts):
        groups.setdefault(re.sub(r"[ \t-\r]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    for r in got:
        body = re.sub(r"[ \t-\r]", "", r.text or "")
        first = min(groups[body])[3]
        assert (r.keep_id, r.group_size) == (first, len(groups[body])) and r.text_sha256 == hashlib.sha256(body.encode()).hexdigest()
    assert sum(r.kept for r in got) == len(groups)
    assert got[0].lang is None and "n_hit" in got[0]


def test_exact_past_the_filter(spark):
    """A filter far too small lets every row take the shuffle; the result is the same."""
    docs = make(spark, [f"t{i % 700}" for i in range(1000)])
    digested = exact.with_digests(docs.select("doc_id", "text"))
    few = {tuple(r) for r in exact.resolve(digested, max_bits=1024).collect()}
    assert few == {tuple(r) for r in exact.resolve(digested).collect()} and sum(r[4] if isinstance(r[4], bool) else r[3] for r in few)


def test_exact_empty(spark):
    assert exact.exact_dedup(make(spark, [])).count() == 0


# --- lines --------------------------------------------------------------------------------


@pytest.mark.parametrize("least", [2, 4])
def test_lines_against_brute_force(spark, least):
    rng = random.Random(2)
    pool = ["Alpha ", "alpha", "\tBETA", "", "   ", "gamma delta", "É", "é", "only\x0b"]
    texts = edge_texts() + ["\n".join(rng.choice(pool) + ("" if rng.random() < 0.7 else str(rng.randrange(9))) for _ in range(rng.randrange(1, 30))) for _ in range(40)]
    texts += [texts[-1]] * 3
    ids = [i if i % 9 else None for i in range(len(texts))]

    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    counts = {}
    for t in texts:
        for k in {key(x) for x in (t or "").split("\n")}:
            counts[k] = counts.get(k, 0) + 1
    want = []
    for i, t in zip(ids, texts):
        own = (t or "").split("\n")
        kept = [x for x in own if not key(x) or counts[key(x)] < least]
        want.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    got = lines.line_dedup(make(spark, texts, ids), min_docs=least).collect()
    assert sorted(map(str, [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got])) == sorted(map(str, want))
    assert got[0].kept == "x"


def test_lines_empty(spark):
    assert lines.line_dedup(make(spark, [])).count() == 0


# --- decontamination ----------------------------------------------------------------------


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


@pytest.mark.parametrize("block", [200_000, 3])
def test_decontamination_against_brute_force(spark, block):
    rng = random.Random(4)
    vocabulary = PROSE.split()
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [prose(25), prose(10), prose(3), "The", "two Wizards", None, "...", prose(12)]
    items.append(items[0])
    texts = edge_texts() + [prose(30) for _ in range(20)] + [f"{prose(5)} {items[0].upper()}; {prose(4)}", f"x {items[1]}, {items[1]} y", items[7][:-1]]
    bench = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(items)] + [(None, items[7], "n")], "item_id bigint, text string, spans string")
    got = {r.doc_id: r for r in decontam.decontaminate(make(spark, texts), bench, block=block).collect()}
    assert len(got) == len(texts)
    for d, t in enumerate(texts):
        w, hit, found = words(t), set(), set()
        for i, item in enumerate(items):
            v = words(item)
            for win in ([v[k : k + 10] for k in range(len(v) - 9)] or [v]) if v else []:
                for s in range(len(w) - len(win) + 1):
                    if w[s : s + len(win)] == win:
                        hit |= set(range(s, s + len(win)))
                        found.add(str(i))
        r = got[d]
        assert (r.n_words, r.n_hit, r.n_items, r.item_ids, r.contaminated) == (len(w), len(hit), len(found), sorted(found), bool(hit)), (d, t)


def test_decontamination_empty(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    got = decontam.decontaminate(make(spark, [PROSE, None]), bench).collect()
    assert [(r.n_hit, r.contaminated, r.item_ids) for r in got] == [(0, False, [])] * 2
    full = spark.createDataFrame([(1, PROSE)], "item_id bigint, text string")
    assert decontam.decontaminate(make(spark, []), full).count() == 0


# --- near copies --------------------------------------------------------------------------


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def near_texts():
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    out = edge_texts()
    for k in range(60):
        copy = list(base)
        for _ in range(k % 6):
            copy[rng.randrange(400)] = f"v{rng.randrange(99)}"
        out.append(" ".join(copy))
    return out + [out[-1]] * 5


def brute_components(fps, ids):
    x = np.array(fps, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    label = np.arange(len(x))
    while True:
        lower = np.where(near, label[None, :], len(x)).min(axis=1)
        if (lower == label).all():
            break
        label = lower
    return [min((i for i, l in zip(ids, label) if l == own and i is not None), default=None) for own in label], label


def test_simhash_against_brute_force(spark):
    texts = near_texts()
    ids = [i + 7 if i % 11 else None for i in range(len(texts))]
    docs = make(spark, texts, ids).withColumn("nr", F.monotonically_increasing_id())
    got = simhash.components(docs).collect()
    fps = [brute_fingerprint(t) for t in texts]
    want, _ = brute_components(fps, ids)
    assert sorted(str((i, f, c)) for i, f, c in zip(ids, fps, want)) == sorted(str((r.doc_id, r.fp & (1 << 64) - 1, r.component_id)) for r in got)


def test_near_dedup_keeps_one_of_each_component(spark):
    texts = near_texts()
    _, label = brute_components([brute_fingerprint(t) for t in texts], list(range(len(texts))))
    first = {l: i for i, l in reversed(list(enumerate(label)))}
    kept = simhash.near_dedup(make(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())
    assert simhash.near_dedup(make(spark, [])).count() == 0


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(PROSE.split() * 50)
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "_PIECE", 100)
    assert simhash.fingerprint(text.encode()) == whole == brute_fingerprint(text)


@pytest.mark.parametrize("seed", range(3))
def test_large_groups_link_like_small_ones(seed):
    """All members of one variant: both ways give the same components, over all variants."""
    rng = np.random.default_rng(seed)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    fps = {int(centre)}
    for _ in range(60):
        x = int(centre)
        for b in rng.choice(20, rng.integers(0, 5)):
            x ^= 1 << int(b)
        fps.add(x)
    fps = np.array(sorted(fps), np.uint64)

    def component_sets(forest):
        parent = {int(f): int(f) for f in fps}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for block in range(4):
            keys = (simhash._rest(fps, block)[:, None] ^ np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(48, dtype=np.uint64)])) | np.uint64(block << 48)
            for key in np.unique(keys):
                own = fps[(keys == key).any(axis=1)]
                if len(own) < 2:
                    continue
                for a, b in zip(*forest(own, int(key))):
                    x, y = root(int(a)), root(int(b))
                    parent[max(x, y)] = min(x, y)
        return {f: root(f) for f in parent}

    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    label = np.arange(len(fps))
    for _ in range(len(fps)):
        label = np.where(near, label[None, :], len(fps)).min(axis=1)
    want = {int(f): int(fps[l]) for f, l in zip(fps, label)}
    assert component_sets(lambda own, key: simhash._forest(own)) == component_sets(simhash._large_forest) == want


# --- repeated passages --------------------------------------------------------------------


def brute_repeats(texts, n=200):
    data = [(t or "").encode() for t in texts]
    places = {}
    for d, x in enumerate(data):
        for s in range(len(x) - n + 1):
            places.setdefault(x[s : s + n], []).append((d, s))
    gone = [np.zeros(len(x), bool) for x in data]
    for found in places.values():
        if len(found) > 1:
            for d, s in found:
                gone[d][s : s + n] = True
    return data, gone


def test_suffix_against_brute_force(spark):
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefghij éß\n") for _ in range(n))
    passages = [noise(n) for n in (150, 195, 205, 260, 700)]
    texts = [t if t is None or len(t) < 5000 else t[:5000] for t in edge_texts()]
    texts += [noise(90) + rng.choice(passages) + noise(rng.randrange(200)) + rng.choice(passages) for _ in range(40)]
    texts += ["ab" * 400, "z" * 1000, passages[4] + passages[4], texts[-1], noise(199), noise(200)]
    texts += [passages[3][:210] + "!" + passages[3][211:], passages[4][:350] + noise(20) + passages[4][370:]]
    ids = [*range(len(texts) - 3), None, None, 3]
    got = suffix.remove_repeats(make(spark, texts, ids)).collect()
    data, gone = brute_repeats(texts)
    want = []
    for i, x, g in zip(ids, data, gone):
        spans = int(np.sum(g[1:] & ~g[:-1]) + (len(g) > 0 and g[0]))
        want.append((i, len(x), int(g.sum()), spans, bytes(b for b, out in zip(x, g) if not out)))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in got)
    assert sum(g.sum() for g in gone) > 5000 and got[0].spans == "z"


def long_texts():
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    passage = noise(90_000)
    return ["", noise(150), noise(500) + passage + noise(70), noise(41_000), passage[:70_000] + noise(33), "", noise(7) + passage[20_000:], passage[:32_900], noise(199)]


def test_runs_depend_on_the_text_alone():
    def runs(texts):
        found = {}
        for row, digit, whole, low, high, place, *_ in suffix._scan(pa.array([t.encode() for t in texts], pa.binary())):
            for r, *rest in zip(row.tolist(), digit.tolist(), whole.tolist(), low.tolist(), high.tolist(), place.tolist()):
                found.setdefault(texts[r], []).append(tuple(rest))
        return {t: sorted(v) for t, v in found.items()}

    texts = long_texts()
    want = {t: v for own in texts for t, v in runs([own]).items()}
    assert all(sum(high - low + 1 for _, _, low, high, _ in want[t]) == len(t) - 199 for t in texts if len(t) >= 200)
    assert runs(texts) == runs(texts[::-1]) == want


def test_suffix_when_scans_see_other_batches(spark, monkeypatch):
    """The third scan reads the rows in another order and other batches than the second."""
    original = suffix._near_bytes

    def rebatched(chosen, size):
        scan = original(chosen, size)

        def run(batches):
            rows = pa.Table.from_batches(batches)
            back = rows.take(pa.array(range(len(rows) - 1, -1, -1), pa.int64())).combine_chunks()
            yield from scan(iter(back.to_batches(max_chunksize=2))) if len(rows) else ()

        return run

    texts = long_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    monkeypatch.setattr(suffix, "_near_bytes", rebatched)
    got = {r.doc_id: bytes(r.kept) for r in suffix.remove_repeats(docs).collect()}
    data, gone = brute_repeats(texts)
    assert got == {i: bytes(b for b, out in zip(x, g) if not out) for i, (x, g) in enumerate(zip(data, gone))}


def test_suffix_empty(spark):
    assert suffix.remove_repeats(make(spark, [])).count() == 0


# --- personal data ------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = []
    for k, pattern in enumerate((EMAIL, IP, CARD, PHONE)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if k == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if k == 2 and not (12 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_match_the_plain_patterns():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice("a1.@+ -(%4é9_") for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == plain_spans(text), text
    for text in ("4111 1111 1111 1111", "a@b.c@d.e", "@b.c@d.e", "1.2.3.4.5.6", "0001.2.3.255", "+1 (555) 555-1234", "x..y@a-b.co.uk.", "é@a.b", "1.2.3.0256"):
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "@" * 300_000, "a@" * 150_000, "+1" + "(" * 300_000, "1 " * 150_000])
def test_scanning_is_linear(text):
    assert len(pii.base_spans(text)) <= 100_000


def test_places_of_words():
    rng = random.Random(12)
    pieces = ["owl", "Owl", "owls", "é", "日本", " ", ".", "-", "OWL owl", "x1"]
    for _ in range(300):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(30)))
        data = text.encode()
        want = [(m.start(), m.group().translate(pii._LOWER), m.end()) for m in pii._WORD.finditer(text)]
        words = ["owl", "é", "日本owl", "x1"]
        assert pii._places(data, data.translate(pii.FOLDED), [w.encode() for w in words]) == [w for w in want if w[1] in words]


def test_terms_that_disclose(spark):
    """A code name that only occurs beside one address is removed, a common word stays; copies are one piece of evidence."""
    rng = random.Random(10)
    filler = lambda: " ".join(rng.choice("alpha beta gamma delta epsilon zeta theta".split()) for _ in range(12))
    texts = [f"{filler()} bluebird {rng.choice('abcdefg')}{i} boss@corp.example writes {filler()}" for i in range(8)]
    texts += [f"{filler()} writes {filler()}" for _ in range(60)] + [None, "", "copied owl one@copy.example here"] + ["copied owl one@copy.example here"] * 9
    ids = [*range(len(texts) - 1), None]
    got = pii.sanitise(make(spark, texts, ids)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert [(s.start, s.kind, s.end) for s in r.base_spans] == plain_spans(r.text or "")
        flagged = {r.text[s.start : s.end] for s in r.term_spans}
        assert flagged == ({"bluebird"} if "bluebird" in (r.text or "") else set())
        if flagged:
            assert "bluebird" not in r.clean_text and "[EMAIL]" in r.clean_text and "boss@" not in r.clean_text and r.n_term == 1
        elif not r.base_spans:
            assert r.clean_text == (r.text or "")
    assert pii.sanitise(make(spark, [])).count() == 0


def test_matches_are_counted_by_kind(spark, tmp_path):
    """The counts of the query, several matches of each kind in any order."""
    rng = random.Random(21)
    parts = ["a@b.co", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 555-1234", "owl", "300.1.1.1", "x"]
    texts = [None, "", *parts, *(" , ".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(60))]
    make(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    for r in llm_queries.op2_personal_data(spark, str(tmp_path)).collect():
        found = plain_spans(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == own for _, k, _ in found) for own in range(4)], texts[r.doc_id]
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in found)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_terms_far_from_the_entity(spark):
    """A name at the top discloses the address at the foot, and is marked further down and where the address is not written."""
    rng = random.Random(11)
    filler = lambda n: " ".join(rng.choice("alpha beta gamma delta epsilon zeta theta".split()) for _ in range(n))
    foot = "contact the office at boss@corp.example for more"
    texts = [f"{filler(9)} Bluebird {filler(300)} bluebird {filler(40)} {foot}" for _ in range(20)]
    texts += [f"{filler(30)} bluebird {filler(30)}"] + [f"{filler(40)} contact the office at home for more" for _ in range(200)]
    texts += ["owl " + filler(200) + " one@copy.example"] * 9
    got = pii.sanitise(make(spark, texts)).collect()
    for r in got:
        want = [m.span() for m in re.finditer("bluebird", r.text.lower())]
        assert [(s.start, s.end) for s in r.term_spans if r.text[s.start : s.end].lower() != "owl"] == want, r.text[:80]
        assert "bluebird" not in r.clean_text.lower() and ("owl" not in r.text or not r.term_spans)
    assert sum(r.n_term for r in got) == 41


def _plain_families(texts):
    """Texts linked by half of their five-word shingles or more, by comparing all pairs."""
    shingles = []
    for text in texts:
        words = pii._WORD.findall(text.translate(pii._LOWER))
        shingles.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))})
    family = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(shingles[i] & shingles[j]) * 2 >= len(shingles[i] | shingles[j]):
                old, new = max(family[i], family[j]), min(family[i], family[j])
                family = [new if f == old else f for f in family]
    return family


def _plain_passage(text, entity, term):
    """The five words on both sides of an entity and of a term, where they stand first."""
    start, _, end = next(s for s in plain_spans(text) if pii._entity(text, *s) == entity)
    before, after, words = (pii._WORD.findall(t.lower()) for t in (text[:start], text[end:], text))
    i = words.index(term)
    return tuple(before[-5:]), tuple(after[:5]), tuple(words[max(0, i - 5) : i]), tuple(words[i + 1 : i + 6])


def _plain_rules(texts, generalise=0.8, remove=0.95, min_documents=3):
    """Disclosure of every pair of entity and term, from sets of documents."""
    family = _plain_families(texts)
    entities, terms = {}, {}
    for i, text in enumerate(texts):
        for s in plain_spans(text):
            entities.setdefault(pii._entity(text, *s), set()).add(i)
        for word in pii._WORD.findall(text.translate(pii._LOWER)):
            if len(word) >= 3 and not word.isdigit():
                terms.setdefault(word, set()).add(i)
    out = {}
    for entity, own in entities.items():
        for term, held in terms.items():
            both = own & held
            passages = {_plain_passage(texts[i], entity, term) for i in both}
            if min(len({family[i] for i in both}), len(passages)) >= min_documents and len(own) < len(texts):
                shown = np.log(len(both) * len(texts) / (len(held) * len(own))) / np.log(len(texts) / len(own))
                if shown >= generalise:
                    out[entity, term] = (len(both), "remove" if shown >= remove else "generalise", round(float(shown), 9))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_disclosure_against_brute_force(spark, seed):
    """Every rule with its documents, action and disclosure; near copies, also of three different edits, are one document."""
    rng = random.Random(seed)
    common_words = [f"w{k}x" for k in range(40)]
    filler = lambda n: [rng.choice(common_words) for _ in range(n)]
    texts = []
    for k in range(12):
        address, name = f"person{k}@site{k % 4}.example", f"name{k}"
        for _ in range(rng.randint(2, 8)):
            texts.append(" ".join([*filler(30), name if rng.random() < 0.9 else "nobody", *filler(30), address, *filler(rng.randint(0, 30))]))
        # Some names are also known without the address.
        texts += [" ".join([*filler(40), name, *filler(20)]) for _ in range(rng.choice([0, 0, 1, 4]))]
    for k in range(3):
        body = [*filler(120), f"rare{k}", f"copy{k}@mirror.example", *filler(120)]
        for _ in range(6):
            edited = list(body)
            edited[rng.randrange(100, 120)] = f"edit{rng.randrange(10**6)}"
            texts.append(" ".join(edited))
    # A passage that unrelated documents share.
    passage = [*filler(12), "seal", *filler(12), "box@passage.example", *filler(12)]
    texts += [" ".join(filler(200) + passage + filler(100)) for _ in range(8)]
    texts += [" ".join(filler(60)) for _ in range(60)] + ["short one@two.example", "", "one@two.example"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    found = docs.select("doc_id", F.xxhash64("text").alias("content"), pii._scan()("text").alias("scan"))
    got = {(r.entity, r.term): (r.n_both, r.action, round(r.disclosure, 9)) for r in pii.rules(found, docs, "text", 0.8, 0.95, 3).collect()}
    want = _plain_rules(texts)
    assert got == want
    assert any(t.startswith("name") for _, t in want) and not any(t.startswith(("rare", "seal")) for _, t in want) and {a for _, a, _ in want.values()} == {"remove", "generalise"}


def test_cleaned_text_of_many_matches():
    """Overlaps count once, and the work is linear in the matches."""
    text = "a@b.c x " * 50_000
    base = [{"start": 8 * i, "kind": 0, "end": 8 * i + 5} for i in range(50_000)] + [{"start": 1, "kind": 1, "end": 4}]
    assert pii._cleaned(text, base, [{"start": 6, "end": 7, "action": "remove"}]) == "[EMAIL]  " + "[EMAIL] x " * 49_999
    assert pii._cleaned("", [], []) == ""
