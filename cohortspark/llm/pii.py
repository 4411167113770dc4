"""Personal data: pattern matches, and terms that give them away.

Emails, IP addresses, card and phone numbers are found by fixed patterns and are the protected entities. What a
term discloses about one is measured over whole documents: the pointwise mutual information of
term and entity, as a share of the entity's own information (1: the term never occurs without the
entity). Where terms reach ``generalise`` of it they are replaced by their class, from ``remove`` on they are deleted.

Copies are one piece of evidence: a rule needs ``min_documents`` documents with both entity and term that are not near copies of
each other, and as many that differ in the ``NEAR`` words around the entity or around the term (where each stands first, entities within
``AROUND`` characters), so that a passage found in many documents counts once. Documents with matches are sketched by least hashes of their five-word shingles, ``ROWS`` to a band; texts that share a
band, and texts reachable over such links, are one family (similarity 0.8 shares one of the ``BANDS`` bands in 99.8 % of cases,
0.2 in 2 %). Merging too much can only withhold a rule.

A term is a word with a letter. Rules apply wherever a term stands outside of matches, also far from the entity and in documents
without it. Scanning is linear in the text, also for long runs of characters that never become a match.

Edge cases: a null text is empty; rows with equal ids and texts get equal results and count as documents each; an
empty table gives an empty one. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm import bitmap
from cohortspark.llm.common import FOLDED, LOWER, UPPER, lookup, text_of
from cohortspark.llm.components import connected_components
from cohortspark.shared import cut_lineage

KINDS = ["email", "ip", "card", "phone", "term"]
ADDED = ["n_email", "n_ip", "n_card", "n_phone", "n_term", "base_spans", "term_spans", "clean_text"]
# Fixed by the contract. Possessive runs and the look-behind match the same texts as the plain patterns without trying
# a run of digits from each of its places.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010FFFF]+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_LOWER = str.maketrans(UPPER, LOWER)
#: Words on each side that tell passages apart, and the characters in which those of an entity are looked for.
NEAR, AROUND = 5, 400
#: Words of a shingle; bands of a sketch and least hashes in each.
SHINGLE, BANDS, ROWS = 5, 12, 4
_NUMBERS = np.random.default_rng(5).integers(0, 1 << 64, SHINGLE + 2 * BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
#: Words that a task counts before it hands the counts on.
_COUNTED = 200_000


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the local part reaches back to the last match, sign or character that cannot be in it."""
    found, last, mark = [], 0, 0
    for m in _DOMAIN.finditer(text):
        at = m.start()
        begin = max(last, mark)
        # Walk back in steps, so that a long text is not copied for every sign.
        low, step = at, 64
        while low > begin:
            probe = max(begin, low - step)
            other = None
            for other in _NOT_LOCAL.finditer(text, probe, low):
                pass
            if other:
                low = other.end()
                break
            low, step = probe, step * 2
        if low < at:
            found.append((low, m.end()))
            last = m.end()
        mark = at + 1
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of every base match, by start, then kind."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _bands(text: str) -> list[int]:
    """A hash for each band of the text's sketch; fewer words than a shingle make one shingle, a text without words has no band."""
    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return []
    hashed = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    n = max(len(words) - SHINGLE + 1, 1)
    shingles = sum(hashed[j : j + n] * _NUMBERS[j] for j in range(min(SHINGLE, len(words))))
    shingles ^= shingles >> np.uint64(29)
    turns, factors = _NUMBERS[SHINGLE:].reshape(2, -1)
    least = np.array([((shingles ^ t) * f).min() for t, f in zip(turns, factors)], np.uint64).reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), k) - (1 << 63) for k, row in enumerate(least)]


def _scan():
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    kind = pa.struct([("spans", pa.list_(span)), ("entities", pa.list_(pa.string())), ("bands", pa.list_(pa.int64()))])

    def one(text: str) -> dict:
        spans = base_spans(text)
        return {
            "spans": [{"start": a, "kind": k, "end": b} for a, k, b in spans],
            "entities": sorted({_entity(text, *s) for s in spans}), "bands": _bands(text) if spans else [],
        }

    @F.arrow_udf("struct<spans array<struct<start int, kind int, end int>>, entities array<string>, bands array<bigint>>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([one(t.as_py()) for t in texts], kind)

    return run


def _entity(text: str, start: int, kind: int, end: int) -> str:
    value = text[start:end]
    return f"{KINDS[kind]}:" + (value.translate(_LOWER) if kind < 2 else "".join(c for c in value if c.isdigit()))


def _may_hold(bits, size: int, values: list[bytes]) -> list[bool]:
    """Whether the filter may hold the strings, hashed as ``xxhash64`` does."""
    slots = np.array([xxhash.xxh64_intdigest(v, 42) & (size - 1) for v in values], np.int64)
    return bitmap._get(bits, slots).tolist()


def _held(bits, size: int, folded: bytes) -> list[bytes]:
    """The distinct words of a folded text that the filter may hold."""
    own = list(set(folded.split()))
    return [w for w, h in zip(own, _may_hold(bits, size, own)) if h]


def _is_term(word: str) -> bool:
    return len(word) >= 3 and not word.isdigit()


def _surroundings(text: str, start: int, end: int) -> str:
    before, after = _WORD.findall(text, max(0, start - AROUND), start), _WORD.findall(text, end, end + AROUND)
    return " ".join(before[-NEAR:] + ["\n"] + after[:NEAR]).translate(_LOWER)


def _pairs(wanted, size: int):
    """Each entity that the filter may hold with every term of the document, once; and the hash of both surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            for text, content in zip(batch.column(0), batch.column(1).to_pylist()):
                text, first_span = text.as_py(), {}
                for span in base_spans(text):
                    first_span.setdefault(_entity(text, *span), span)
                own = list(first_span)
                own = [e for e, held in zip(own, _may_hold(bits, size, [e.encode() for e in own])) if held]
                if not own:
                    continue
                words, first = _WORD.findall(text.translate(_LOWER)), {}
                for i, word in enumerate(words):
                    if word not in first and _is_term(word):
                        first[word] = " ".join(words[max(0, i - NEAR) : i] + ["\n"] + words[i + 1 : i + 1 + NEAR])
                terms = pa.array(list(first), pa.string())
                same = pa.array([content] * len(terms), pa.int64())
                for entity in own:
                    start, _, end = first_span[entity]
                    around = _surroundings(text, start, end)
                    context = [xxhash.xxh64_intdigest(f"{around}\n{c}") - (1 << 63) for c in first.values()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([entity] * len(terms), pa.string()), terms, same, pa.array(context, pa.int64())], ["entity", "term", "content", "context"]
                    )

    return run


def _held_words(wanted, size: int):
    """How many texts of the task hold each word that the filter may hold; counts are handed on when there are ``_COUNTED`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, counts = wanted.value, Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

        for batch in batches:
            for text in batch.column(0):
                counts.update(_held(bits, size, text.as_py().translate(FOLDED)))
            if len(counts) >= _COUNTED:
                yield rows()
                counts.clear()
        if counts:
            yield rows()

    return run


def _places(data: bytes, folded: bytes, held: list[bytes]) -> list[tuple[int, str, int]]:
    """Start, word and end, in code points, of every occurrence of the words, by start."""
    padded, found = b" " + folded + b" ", []
    for word in held:
        at, sought = -1, b" " + word + b" "
        # The space behind one word is the one before the next.
        while (at := padded.find(sought, at + 1)) >= 0:
            found.append((at, word))
    out, seen, points = [], 0, 0
    for at, word in sorted(found):
        points += len(data[seen:at].decode())
        own = word.decode()
        out.append((points, own, points + len(own)))
        seen = at
    return out


def _marked(wanted, size: int):
    """Words of a text that the filter may hold, outside of matches. Only texts that have some are looked at word by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            for row, data in enumerate(batch.column(2)):
                data = data.as_py()
                folded = data.translate(FOLDED)
                held = _held(bits, size, folded)
                if not held:
                    continue
                spans, at, kept, reach = base_spans(data.decode()), 0, [], 0
                for a, word, b in _places(data, folded, held):
                    while at < len(spans) and spans[at][0] < b:
                        reach = max(reach, spans[at][2])
                        at += 1
                    if reach <= a:
                        kept.append((word, a, b))
                own = pa.array([row] * len(kept), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), batch.column(1).take(own), pa.array([w for w, _, _ in kept], pa.string()),
                     pa.array([a for _, a, _ in kept], pa.int32()), pa.array([b for _, _, b in kept], pa.int32())],
                    ["id", "content", "term", "start", "end"],
                )

    return run


def families(found: DataFrame) -> DataFrame:
    """content and family of the texts that are near copies of another text; all others stand for themselves."""
    bands = cut_lineage(found.select("content", F.explode("scan.bands").alias("band")))
    heads = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("head"), F.max("content").alias("last")).filter("head <> last").drop("last")
    met = lookup(bands, heads, ["band"], "n", bands.count(), F.col("content")).filter("head IS NOT NULL")
    return cut_lineage(connected_components(met.select(F.col("head").alias("a"), F.col("content").alias("b"))).withColumnsRenamed({"node": "content", "component": "family"}))


def _with_family(rows: DataFrame, related: DataFrame, spread: Column) -> DataFrame:
    """``rows`` with the family of their content."""
    sizes = rows.groupBy("content").agg(F.count(F.lit(1)).alias("n_rows"))
    return lookup(rows, related.join(sizes, "content"), ["content"], "n_rows", rows.count(), spread).withColumn("family", F.coalesce("family", "content"))


def rules(found: DataFrame, docs: DataFrame, text: str, generalise: float, remove: float, min_documents: int) -> DataFrame:
    """entity, term, n_both (documents with both), disclosure and action, for the terms that disclose too much."""
    total = F.lit(max(found.count(), 1)).cast("double")
    related = families(found)
    named = found.select("content", F.explode("scan.entities").alias("entity")).groupBy("entity", "content").agg(F.count(F.lit(1)).alias("n"))
    # Others have too few documents for any rule.
    entities = cut_lineage(
        _with_family(cut_lineage(named), related, F.col("entity")).groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count_distinct("family").alias("n_families"))
        .filter(F.col("n_families") >= min_documents).select("entity", "n_entity")
    )
    size = bitmap.size_for(entities.count())
    wanted = bitmap.build(entities.select(F.xxhash64("entity").alias("h")), size)
    source = docs.select(text_of(text).alias("text"), F.xxhash64(text_of(text)).alias("content"))
    pairs = cut_lineage(
        source.mapInArrow(_pairs(wanted, size), "entity string, term string, content bigint, context bigint")
        .groupBy("entity", "term", "content").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("context"))
    )
    wanted.destroy()
    both = cut_lineage(
        _with_family(pairs, related, F.struct("entity", "term")).groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count_distinct("family").alias("n_families"), F.count_distinct("context").alias("n_contexts"))
        .filter(F.least("n_families", "n_contexts") >= min_documents)
    )
    # Documents are counted for the terms that are left, not for all words there are.
    candidates = both.select(F.xxhash64("term").alias("h")).distinct()
    size = bitmap.size_for(candidates.count())
    asked = bitmap.build(candidates, size)
    held = docs.select(text_of(text).cast("binary").alias("text")).mapInArrow(_held_words(asked, size), "term string, n bigint")
    terms = cut_lineage(held.groupBy("term").agg(F.sum("n").alias("n_term")))
    asked.destroy()
    own = F.log(total / F.col("n_entity"))
    shared = F.log(F.col("n_both") * total / (F.col("n_term") * F.col("n_entity")))
    return (
        lookup(both, entities.join(both.groupBy("entity").agg(F.count(F.lit(1)).alias("n_rows")), "entity"), ["entity"], "n_rows", both.count(), F.col("term"))
        # The filter may have let through an entity that has no rule.
        .filter("n_entity IS NOT NULL").join(terms, "term").withColumn("disclosure", F.when(own > 0, shared / own).otherwise(0.0))
        .filter(F.col("disclosure") >= generalise)
        .select("entity", "term", "n_both", "disclosure", F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise").alias("action"))
    )


def _cleaned(text: str, base: list[dict], terms: list[dict]) -> str:
    """The text with matches replaced by their kind, and terms by their class or nothing; what overlaps an earlier one adds nothing."""
    found = [(s["start"], s["end"], f"[{KINDS[s['kind']].upper()}]") for s in base]
    found += [(s["start"], s["end"], "" if s["action"] == "remove" else "[TERM]") for s in terms]
    parts, at = [], 0
    for start, end, by in sorted(found):
        if start >= at:
            parts += [text[at:start], by]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _clean(text: Column, base: Column, terms: Column) -> Column:
    @F.arrow_udf("string")
    def run(texts: pa.Array, matches: pa.Array, words: pa.Array) -> pa.Array:
        return pa.array([_cleaned(t.as_py(), b.as_py(), w.as_py()) for t, b, w in zip(texts, matches, words)], pa.string())

    return run(text, base, terms)


def _of_kind(kind: int):
    # One parameter only: Spark hands a second one, also one with a default, the index of the element.
    return lambda span: span["kind"] == kind


def sanitise(
    docs: DataFrame, key: str = "doc_id", text: str = "text", generalise: float = 0.8, remove: float = 0.95, min_documents: int = 3, clean: bool = True,
) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone, n_term, base_spans, term_spans and, if ``clean``, clean_text."""
    docs = docs.drop(*ADDED)
    content = F.xxhash64(text_of(text))
    # Scanned once and stored: spans of matches and sketches of texts that have some, a small part of the texts.
    found = cut_lineage(docs.select(F.col(key).alias("id"), content.alias("content"), _scan()(text_of(text)).alias("scan"), F.monotonically_increasing_id().alias("row")))
    disclosed = cut_lineage(rules(found, docs, text, generalise, remove, min_documents).groupBy("term").agg(F.max("action").alias("action")))
    size = bitmap.size_for(disclosed.count())
    wanted = bitmap.build(disclosed.select(F.xxhash64("term").alias("h")), size)
    kind = found.schema["id"].dataType.simpleString()
    source = docs.select(F.col(key).alias("id"), content.alias("content"), text_of(text).cast("binary").alias("text"))
    mentions = source.mapInArrow(_marked(wanted, size), f"id {kind}, content bigint, term string, start int, end int")
    mentions = source.sparkSession.createDataFrame([], mentions.schema) if disclosed.isEmpty() else cut_lineage(mentions)
    wanted.destroy()
    facts = disclosed.join(mentions.groupBy("term").agg(F.count(F.lit(1)).alias("n_rows")), "term")
    terms = (
        lookup(mentions, facts, ["term"], "n_rows", mentions.count(), F.struct("content", "start")).filter("action IS NOT NULL")
        .groupBy("id", "content", "start", "end").agg(F.max("action").alias("action"))
        .groupBy("id", "content").agg(F.array_sort(F.collect_list(F.struct("start", "end", "action"))).alias("term_spans"))
    )
    none = F.expr("CAST(array() AS ARRAY<STRUCT<start: INT, end: INT, action: STRING>>)")
    # Rows with equal id and text have equal results.
    results = found.select("id", "content", F.col("scan.spans").alias("base_spans")).dropDuplicates(["id", "content"]).join(
        terms.withColumnsRenamed({"id": "tid", "content": "tcontent"}), F.col("id").eqNullSafe(F.col("tid")) & (F.col("content") == F.col("tcontent")), "left"
    ).select("id", "content", "base_spans", F.coalesce("term_spans", none).alias("term_spans"))
    counts = [F.size(F.filter("base_spans", _of_kind(k))).cast("bigint").alias(f"n_{KINDS[k]}") for k in range(4)]
    joined = docs.withColumn("_content", content).join(results, F.col(key).eqNullSafe(F.col("id")) & (F.col("_content") == F.col("content")))
    out = joined.select(*docs.columns, *counts, F.size("term_spans").cast("bigint").alias("n_term"), "base_spans", "term_spans")
    return out.withColumn("clean_text", _clean(text_of(text), F.col("base_spans"), F.col("term_spans"))) if clean else out


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, by start, then kind."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
