"""Joining a very large fact to a dimension that is usually, not always, small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import AtomicType, NumericType, VariantType

# A broadcast copy sits in every executor, so it stays well under their memory.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with a larger share of the fact than this is split in the shuffled join.
HOT_SHARE = 0.001


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size, from an aggregate over every row.

    A row is its text with nulls written out, a word for each column, and what a
    hash table adds.
    """
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    width = F.octet_length(text) + F.lit(8 * len(df.columns) + 48)
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` may be broadcast. Runs one aggregate over it."""
    return measured_bytes(df) <= limit


def hot_keys(fact: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys with more than ``share`` of the rows, and in how many slices to cut them.

    A slice holds about ``share`` of the rows. There are fewer than ``1 / share``
    such keys and ``2 / share`` slices whatever the data, which bounds what is
    broadcast. Counts are combined before they are shuffled.
    """
    counted = fact.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return slices_of(counted, keys, fact.count() * share)


def slices_of(counted: DataFrame, keys: Sequence[str], fair: float) -> DataFrame:
    """Keys with more than ``fair`` of the counted ``_rows``, and in how many slices to cut them."""
    fair = max(1.0, fair)
    return counted.filter(F.col("_rows") > fair).select(*keys, F.ceil(F.col("_rows") / F.lit(fair)).alias("_slices"))


def fact_join(
    fact: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    broadcast: bool,
    hot: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Inner, or left, equi-join on the columns ``on``.

    With ``broadcast`` the fact is not shuffled at all. Otherwise both sides are
    shuffled on (key, slice): rows of a hot key draw one of its slices from their
    content and their input task, so copies are spread too, and the small side is
    repeated once per slice of a hot key only. Each fact row still meets each
    matching dimension row exactly once. ``hot`` is what :func:`hot_keys` says
    about the fact unless given.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if broadcast:
        return fact.join(F.broadcast(small), keys, how)
    split = F.broadcast(hot_keys(fact, keys) if hot is None else hot)
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    draw = F.xxhash64(F.spark_partition_id(), *_hashable(fact))
    cut = fact.join(split, keys, "left").withColumn("_slice", F.pmod(draw, slices)).drop("_slices")
    repeated = (
        small.join(split, keys, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)))
        .drop("_slices")
    )
    return cut.join(repeated.hint("merge"), [*keys, "_slice"], how).drop("_slice")


def _hashable(df: DataFrame) -> list[str]:
    """Columns of simple types; variants and maps cannot be hashed."""
    simple = (AtomicType, NumericType)
    return [
        field.name
        for field in df.schema
        if isinstance(field.dataType, simple) and not isinstance(field.dataType, VariantType)
    ]
