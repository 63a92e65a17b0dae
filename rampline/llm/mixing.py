"""Mixing sources to target weights by hash thresholds, in DataFrame operations only.

Every row has a hash that depends on nothing but the row. A source's budget is a number of
whole passes over it and a rest; the rest takes the rows whose hash lies below the source's
threshold. So a smaller budget takes a subset of a larger one, and nothing is sorted: words
are summed by source and leading hash bits, the bucket in which the budget ends is found
from these sums, and only that bucket is summed again by its next bits.

Edge cases: null and empty texts have size 0; a null source is one source, ordered last.
Rows equal in id and text share a hash; if the budget ends among them, each is taken by the
hash of its place in the input, with the probability that meets the budget. Sources without
words have the target 0. An empty table gives an empty result. ``mixed`` returns the input's
columns only; its own working columns carry a prefix that no input column may have.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from rampline.llm.common import as_text, n_words_of, small, written

WEIGHTS = (1, 2, 3)
MOST_PASSES = 3

DIGIT_BITS = 12
LEVELS = 5
HASH_BITS = DIGIT_BITS * LEVELS
PREFIX = "_mix_"


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of a row's id and text; any engine can compute them."""
    digest = F.md5(F.concat_ws("|", as_text(doc_id), as_text(text)))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_passes: int = MOST_PASSES) -> DataFrame:
    """The target of each (source, source_size) of ``totals``.

    Weights go to the sources by code point, null last, again and again. Where a share exceeds
    ``most_passes`` times its source, the target stops there and the rest is shared anew: with
    sources in order of size by weight those at their limit come first, so the final share of a
    unit of weight is that of the first source that stays below its limit. The table has one
    row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    limit = F.lit(float(most_passes)) * F.col("source_size")
    at = F.row_number().over(by_name)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = totals.select(
        "source", "source_size", at.alias("at"), F.get(cycle, (at - 1) % len(weights)).alias("weight")
    )
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), "at")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    capped = F.lit(float(most_passes)) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    shared = weighted.select(
        "*",
        F.row_number().over(filled).alias("rank"),
        ((F.sum("source_size").over(everything) - capped) / F.sum("weight").over(after)).alias("unit"),
    )
    below = F.col("unit") * F.col("weight") <= limit
    unit = F.min_by(F.when(below, F.col("unit")), F.when(below, F.col("rank"))).over(everything)
    return shared.select(
        "source", "source_size", F.least(limit, F.col("weight") * F.coalesce(unit, F.lit(0.0))).alias("target")
    )


def budgets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per source its size, target, whole passes, threshold, and the share of rows taken at the threshold.

    ``sizes`` has (source, size, hash) of every row and is read once per level, each time for
    the rows of one bucket per source only.
    """
    totals = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-totals")
    n_sources = totals.count()
    whole = F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0))
    planned = (
        targets(totals, weights)
        .withColumn("passes", whole.cast("long"))
        .withColumn(
            "rest",
            F.greatest(F.lit(0.0), F.col("target") - F.col("passes").cast("double") * F.col("source_size")),
        )
    )
    planned = written(planned, "mix-targets")

    # The bucket of each source in which its budget ends, and the words before it.
    open_at = planned.select("source", "rest", F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("base"))
    for level in range(1, LEVELS + 1):
        inside = F.shiftright("hash", HASH_BITS - DIGIT_BITS * (level - 1))
        ended = small(open_at.withColumnRenamed("source", "at_source"), n_sources)
        rows = sizes.join(ended, F.col("source").eqNullSafe(F.col("at_source")) & (inside == F.col("bucket")))
        sums = rows.groupBy(
            "source", "rest", "base", F.shiftright("hash", HASH_BITS - DIGIT_BITS * level).alias("at")
        ).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        in_order = Window.partitionBy("source").orderBy("at")
        running = sums.withColumn("end", F.col("base") + F.sum("words").over(in_order))
        over = running.where(F.col("end") > F.col("rest"))
        first = over.groupBy("source", "rest").agg(
            F.min("at").alias("bucket"), F.min_by(F.col("end") - F.col("words"), "at").alias("base"),
            F.min_by("n", "at").alias("n"), F.min_by("words", "at").alias("words"),
        )
        open_at = written(first, "mix-level")
    middle = (F.col("rest") - F.col("base")) / F.col("words") * F.col("n")
    ends = open_at.select(
        F.col("source").alias("at_source"),
        F.col("bucket").alias("threshold"),
        (F.floor(middle + 0.5) / F.col("n")).alias("share"),
    )
    return (
        planned.join(small(ends, n_sources), F.col("source").eqNullSafe(F.col("at_source")), "left")
        .select(
            "source",
            "source_size",
            "target",
            "passes",
            # without an end inside the source, the rest takes either nothing or every row
            F.coalesce("threshold", F.when(F.col("rest") > 0, F.lit(2**HASH_BITS)).otherwise(F.lit(0))).alias(
                "threshold"
            ),
            F.coalesce("share", F.lit(0.0)).alias("share"),
        )
    )


def _copies(hashed: Column, place: Column) -> Column:
    drawn = F.shiftrightunsigned(F.xxhash64(place), 11).cast("double") / float(2**53)
    at = F.col(PREFIX + "threshold")
    extra = F.when(hashed < at, 1).when((hashed == at) & (drawn < F.col(PREFIX + "share")), 1).otherwise(0)
    return F.col(PREFIX + "passes") + extra


def _sizes(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        "source",
        n_words_of(F.col("text")).alias("size"),
        row_hash(F.col("doc_id"), F.col("text")).alias("hash"),
        F.monotonically_increasing_id().alias("place"),
    )


def _with_budget(rows: DataFrame, sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    budget = budgets(sizes, weights)
    found = written(budget.select(*[F.col(c).alias(PREFIX + c) for c in budget.columns]), "mix-budgets")
    return rows.join(small(found, found.count()), rows["source"].eqNullSafe(F.col(PREFIX + "source")))


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes of it."""
    sizes = written(_sizes(docs), "mix-sizes")
    return _with_budget(sizes, sizes, weights).select(
        "doc_id",
        "size",
        F.col(PREFIX + "source_size").alias("source_size"),
        F.col(PREFIX + "target").alias("target"),
        (F.col("size") * _copies(F.col("hash"), F.col("place"))).alias("taken"),
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as their source's budget takes them."""
    columns = docs.columns
    if clash := [c for c in columns if c.startswith(PREFIX)]:
        raise ValueError(f"columns {clash} carry the prefix of working columns")
    rows = docs.withColumn(PREFIX + "place", F.monotonically_increasing_id())
    joined = _with_budget(rows, written(_sizes(docs), "mix-sizes"), weights)
    copies = _copies(row_hash(F.col("doc_id"), F.col("text")), F.col(PREFIX + "place"))
    repeated = F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias(PREFIX + "copy")
    return joined.select(*columns, repeated).select(*columns)
