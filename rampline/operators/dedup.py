"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import VariantType

# How many tasks the copies of one key are spread over before the final pass.
DEFAULT_SPREAD = 64
# Repeated keys that one task remembers while it combines copies. Only a key with a large
# share of the rows has to be combined, and there cannot be many of those; a short memory
# keeps the lookup cheaper than the batch it is for.
REMEMBERED_KEYS = 256


def first_seen(
    df: DataFrame,
    keys: Sequence[str],
    spread: int = DEFAULT_SPREAD,
    within: str | None = None,
    arrived: Column | None = None,
) -> DataFrame:
    """First arrival wins, across runs when ``df`` is a stream.

    A batch combines the copies of a key before it shuffles. A stream does not:
    every copy travels to the task that owns the key, so a key holding a third of
    the rows would stall the whole batch. Copies are therefore reduced first, in
    one of two ways that both leave the result as it is:

    * :func:`combine_copies`, which keeps no state and shuffles nothing;
    * for rows with a variant, a pass of its own per (key, slice of the input
      tasks), which leaves at most ``spread`` rows of a key. It costs a state
      entry per key and slice, so it is for dimensions, not for facts.

    State grows with the keys for ever, unless a stream is told ``within`` what time, such as
    ``30 days``, copies come: a key is remembered at least that long after its first row, until
    a micro-batch has shown that more time has passed, and a copy that comes after that is
    kept like a first row. The time is that of arrival, ``arrived`` or else the
    moment of the micro-batch, never that of the reading: a watermark on arrival falls behind no
    row, so that however old a reading is, its first row is kept. ``arrived`` must not go
    back between micro-batches.
    """
    keys = list(keys)
    if within is not None:
        if not df.isStreaming:
            raise ValueError("only a stream forgets keys")
        return _first_seen_within(df, keys, within, arrived)
    if df.isStreaming:
        if any(isinstance(field.dataType, VariantType) for field in df.schema):
            sliced = df.withColumn("_slice", F.spark_partition_id() % spread)
            df = sliced.dropDuplicates([*keys, "_slice"]).drop("_slice")
        else:
            df = combine_copies(df, keys)
    return df.dropDuplicates(keys)


def _first_seen_within(df: DataFrame, keys: list[str], within: str, arrived: Column | None) -> DataFrame:
    stamped = df.withColumn("_arrived", F.current_timestamp() if arrived is None else arrived)
    if not any(isinstance(field.dataType, VariantType) for field in df.schema):
        stamped = combine_copies(stamped, keys)
    return stamped.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(keys).drop("_arrived")


def combine_copies(df: DataFrame, keys: Sequence[str], remember: int = REMEMBERED_KEYS) -> DataFrame:
    """Drop copies that meet in one task: a map-side combine for streams.

    Each Arrow batch keeps the first row of every key. Keys that were repeated
    most often are remembered, and later batches of the task drop them altogether,
    so a hot key leaves a task about once. Memory is bounded by ``remember``; whatever
    slips through is left to the deduplication behind. Batches without repeated
    keys are passed on untouched.
    """
    keys = list(keys)

    def combine(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        hot = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            index = pa.array(np.arange(rows.num_rows))
            groups = (
                rows.select(keys)
                .append_column("_row", index)
                .group_by(keys, use_threads=False)
                .aggregate([("_row", "min"), ("_row", "count")])
            )
            kept = groups
            if hot is not None:
                kept = groups.join(hot, keys, join_type="left anti", use_threads=False)
            repeated = kept.filter(pc.greater(kept["_row_count"], 1))
            if repeated.num_rows:
                # the most repeated come last, where the memory is cut
                most = repeated.sort_by("_row_count").slice(max(0, repeated.num_rows - remember)).select(keys)
                hot = most if hot is None else pa.concat_tables([hot, most])
                hot = hot.slice(max(0, hot.num_rows - remember)).combine_chunks()
            if kept.num_rows < rows.num_rows:
                rows = rows.take(kept["_row_min"].sort())
            yield from rows.to_batches()

    return df.mapInArrow(combine, df.schema)


def lowest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row that sorts lowest per key; a repeatable choice for batches.

    An aggregate, not a ranking window: copies are combined before the shuffle
    and no task ever holds all the rows of a key. As the row kept is a struct,
    which Spark aggregates by sorting, each task sorts its input by key before
    and once more after the shuffle.
    """
    payload = [name for name in df.columns if name not in set(keys)]
    if not payload:
        return df.dropDuplicates(list(keys))
    pick = F.min_by(F.struct(*payload), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(pick).select(*keys, "_row.*").select(*df.columns)
