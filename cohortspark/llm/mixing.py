"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in built-in functions only.

Every source has a weight and a size (the sum of its documents' sizes). The budget is a multiple of all sizes; a source's target is its share
by weight, at most ``max_epochs`` times its size, and what exceeds that is shared again by weight until no source is above. A source is
first taken whole as often as its target allows: complete epochs. The rest of the target is drawn without replacement: each document gets
an exponential key divided by its quality weight, keys are sorted within the source and sizes summed up along them; documents
inside the budget are taken once more, and the one on the border gives the first words that are missing.

No source is sorted in one place. Keys are cut into bins on a logarithmic scale, finer the more rows a source has, so that a bin holds about
``BIN_ROWS`` rows; a running total per bin and the totals of the bins before it give each document's place. Facts per source are looked up with hot
sources broadcast and the others shuffled; the driver sees a few sums.

Edge cases: a null source is a source of its own, the last; a null text or size is 0; a null quality weight is 1, and documents with one of 0 or
less come after all others of their source; keys depend on seed, id and content, so reruns agree; rows equal in id and content tie and follow each
other. Sources without words have target 0. An empty table gives an empty one. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import lookup, text_of
from cohortspark.shared import cut_lineage

ADDED = ["source_size", "target", "taken"]
#: Rows of a source that are sorted together, about.
BIN_ROWS = 8_000
# Fixed by the contract: a word, and the weights that sources get in turn.
WORD = r"[^\x20\x09-\x0D]+"
TURNS = (5.0, 2.0, 1.0)


def word_count(text: str | Column) -> Column:
    """Words of a text: each becomes one letter, and letters are counted."""
    return F.length(F.translate(F.regexp_replace(text_of(text), WORD, "w"), " \t\n\x0b\x0c\r", "")).cast("bigint")


def _facts(docs: DataFrame, source: str, size: str) -> DataFrame:
    own = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    name = F.col(source).cast("string")
    # Null and empty are different sources, and lookups need keys that are not null.
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("size"), name.isNull().alias("none"), F.coalesce(name, F.lit("")).alias("name")
    )


def in_turn(sources: DataFrame, turns: tuple[float, ...] = TURNS) -> DataFrame:
    """``sources`` with a ``weight``: the turns in the order of name, null last; order by ranges, so that no task gets them all."""
    parts = sources.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = cut_lineage(sources.repartitionByRange(int(parts), "none", "name").withColumn("part", F.spark_partition_id()))
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row per partition.
    offsets = counts.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("part").orderBy("none", "name")) - 1
    placed = ranged.withColumn("place", place).join(F.broadcast(offsets), "part")
    turn = F.get(F.array(*map(F.lit, turns)), F.pmod(F.col("place") + F.col("before"), F.lit(len(turns))).cast("int"))
    return placed.select(*sources.columns, turn.alias("weight"))


def level(sources: DataFrame, share: float, max_epochs: float) -> tuple[float, float]:
    """The targets' rate per unit of weight once every source at its limit stands still; and the budget.

    Each round sums once over the sources; rounds end when no further source is above its limit.
    """
    limit, most = F.col("source_size") * F.lit(max_epochs), F.col("weight")
    total, weights = sources.agg(F.sum("source_size"), F.sum(F.when(F.col("source_size") > 0, most))).first()
    budget = min(share, max_epochs) * float(total or 0)
    rate, fixed = (budget / weights if weights else 0.0), -1
    while weights:
        above = F.col("weight") * F.lit(rate) >= limit
        held, rest, n = sources.filter("source_size > 0").agg(F.sum(F.when(above, limit)), F.sum(F.when(~above, most)), F.count_if(above)).first()
        if n == fixed or not rest:
            break
        fixed, rate = n, (budget - float(held or 0)) / float(rest)
    return rate, budget


def _uniform(seed: int, key: str, content: str | None) -> Column:
    """A number between 0 and 1 from the row itself, never either."""
    named = [F.lit(seed), F.coalesce(F.col(f"row.`{key}`").cast("string"), F.lit(""))] + ([F.col(f"row.`{content}`")] if content else [])
    return (F.shiftrightunsigned(F.xxhash64(*named), 11).cast("double") + 0.5) / float(1 << 53)


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", size: str = "size", quality: str | None = None, content: str | None = None, weights: DataFrame | None = None,
    share: float = 1.5, max_epochs: float = 2.0, seed: int = 42, bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """``docs`` with source_size, target (of the source) and taken (size units the mix takes of the document, repeats counted).

    Give narrow rows: all columns travel with the shuffle. ``weights`` holds (source, weight), each source once; without it sources weigh ``TURNS`` in turn.
    ``content`` is a column that tells rows with equal ids apart.
    """
    docs = docs.drop(*ADDED)
    rows = cut_lineage(_facts(docs, source, size))
    sources = cut_lineage(rows.groupBy("none", "name").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")))
    if weights is None:
        sources = cut_lineage(in_turn(sources))
    else:
        name = F.col(source).cast("string")
        given = weights.select(name.isNull().alias("none"), F.coalesce(name, F.lit("")).alias("name"), F.col("weight").cast("double"))
        sources = cut_lineage(sources.join(given, ["none", "name"], "left").withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))))
    rate, _ = level(sources, share, max_epochs)
    target = F.least(F.col("weight") * F.lit(rate), F.col("source_size") * F.lit(max_epochs))
    # A hair of rounding must not cost a whole epoch.
    epochs = F.floor(target / F.nullif(F.col("source_size"), F.lit(0)) + 1e-12).cast("bigint")
    octaves = F.ceil(F.log2(F.greatest(F.col("n") / F.lit(bin_rows), F.lit(1.0))))
    told = sources.select(
        "none", "name", "n", "source_size", target.alias("target"), F.coalesce(epochs, F.lit(0).cast("bigint")).alias("epochs"),
        F.when(octaves > 0, F.pow(F.lit(2.0), octaves)).otherwise(0.0).alias("per_octave"),
    )
    tie = F.xxhash64(F.col(f"row.`{key}`").cast("string"), *([F.col(f"row.`{content}`")] if content else []), "size")
    known = lookup(rows.withColumn("tie", tie), told, ["none", "name"], "n", rows.count(), F.col("tie"))
    weight = F.coalesce(F.col(f"row.`{quality}`").cast("double"), F.lit(1.0)) if quality else F.lit(1.0)
    drawn = known.withColumn("draw", F.when(weight > 0, -F.log(_uniform(seed, key, content)) / weight).otherwise(F.lit(float("inf"))))
    # An octave holds a quarter of all exponential keys at most, so a bin about a quarter of ``bin_rows``.
    scale = F.log2(F.least(F.greatest(F.col("draw"), F.lit(2.0**-64)), F.lit(2.0**64)))
    binned = cut_lineage(drawn.withColumn("bin", F.floor(scale * F.col("per_octave")).cast("bigint")))
    here = ["none", "name", "bin"]
    order = Window.partitionBy(*here).orderBy("draw", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = binned.withColumn("up_to", F.sum("size").over(order))
    totals = binned.groupBy(*here).agg(F.sum("size").alias("bin_size"))
    before = F.sum("bin_size").over(Window.partitionBy("none", "name").orderBy("bin")) - F.col("bin_size")
    placed = within.join(totals.withColumn("before", before).drop("bin_size"), here)
    budget = F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 1e-6)
    once_more = F.least(F.greatest(budget - (F.col("before") + F.col("up_to") - F.col("size")), F.lit(0)), F.col("size"))
    return placed.select(
        *[F.col(f"row.`{c}`") for c in docs.columns], "source_size", "target", (F.col("epochs") * F.col("size") + once_more).cast("bigint").alias("taken")
    )
