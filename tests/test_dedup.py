import pandas as pd
import pytest
from pyspark.sql import functions as F

from rampline.operators.dedup import combine_copies, first_seen, lowest_by

KEYS = ["k", "at"]


def _run(spark, source, out, variant):
    stream = spark.readStream.schema("k string, at long, v double").parquet(source)
    if variant:
        stream = stream.withColumn("more", F.parse_json(F.lit("{}")))
    stream = first_seen(stream, KEYS, 4).select("k", "at", "v")
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/cp")
        .trigger(availableNow=True).start(f"{out}/data")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/data")


def _rows(spark, start, stop):
    """A third of the rows are copies of one key."""
    i = F.col("id")
    return spark.range(start, stop, 1, 6).select(
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), i % 7)).alias("k"),
        F.when(i % 3 == 0, F.lit(0)).otherwise(i % 50).cast("long").alias("at"),
        (i * 1.5).alias("v"),
    )


@pytest.mark.parametrize("variant", [False, True])
def test_stream_keeps_one_row_per_key_across_runs(spark, tmp_path, variant):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    _rows(spark, 0, 600).write.mode("append").parquet(source)
    first = _run(spark, source, out, variant).toPandas()
    assert not first.duplicated(KEYS).any()

    _rows(spark, 300, 900).write.mode("append").parquet(source)
    _run(spark, source, out, variant)
    again = _run(spark, source, out, variant).toPandas()  # nothing new: nothing changes
    assert not again.duplicated(KEYS).any()
    everything = _rows(spark, 0, 900).toPandas()
    assert set(map(tuple, again[KEYS].values)) == set(map(tuple, everything[KEYS].values))
    kept = first.merge(again, on=KEYS, suffixes=("_then", "_now"))
    assert len(kept) == len(first) and (kept["v_then"] == kept["v_now"]).all()


@pytest.mark.parametrize("variant", [False, True])
def test_only_copies_within_the_bound_go(spark, tmp_path, variant):
    """Deliveries on days 0, 2 and 9, the first two within three days of each other, and later ones."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    state = []

    def deliver(day, keys):
        at = F.timestamp_add("DAY", F.lit(day), F.lit("2026-01-01 00:00:00").cast("timestamp"))
        rows = spark.createDataFrame([(k, 0, float(day)) for k in keys], "k string, at long, v double")
        rows.withColumn("came", at).write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, at long, v double, came timestamp").parquet(source)
        if variant:
            stream = stream.withColumn("more", F.parse_json(F.lit("{}")))
        kept = first_seen(stream, KEYS, within="3 days", arrived=F.col("came")).select("k", "v")
        query = (
            kept.writeStream.format("parquet").option("checkpointLocation", f"{out}/cp")
            .trigger(availableNow=True).start(f"{out}/data")
        )
        query.awaitTermination()
        state.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        return sorted(map(tuple, spark.read.parquet(f"{out}/data").collect()))

    assert deliver(0, ["a", "a", "b"]) == [("a", 0.0), ("b", 0.0)]
    assert deliver(2, ["a", "c"]) == [("a", 0.0), ("b", 0.0), ("c", 2.0)]  # a copy inside the bound goes
    # "old" was read long ago, but it is the first row of its key to arrive
    assert deliver(9, ["d", "old"]) == [("a", 0.0), ("b", 0.0), ("c", 2.0), ("d", 9.0), ("old", 9.0)]
    # "a" was forgotten with day 9; no micro-batch has yet shown that the time of "d" is over
    last = deliver(20, ["a", "d"])
    assert last == [("a", 0.0), ("a", 20.0), ("b", 0.0), ("c", 2.0), ("d", 9.0), ("old", 9.0)]
    assert deliver(21, ["a"]) == last
    assert state[-1] <= 2  # what the bound has passed is forgotten
    assert deliver(22, ["d"]).count(("d", 22.0)) == 1


def test_only_streams_forget(spark):
    with pytest.raises(ValueError, match="stream"):
        first_seen(_rows(spark, 0, 9), KEYS, within="3 days")


def test_moment_of_arrival_loses_no_first_row(spark, tmp_path):
    """Readings far behind all others are no late rows."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for at in (10**9, 5, 10**8):
        spark.createDataFrame([("k", at, 1.0)] * 3, "k string, at long, v double").write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, at long, v double").parquet(source)
        query = (
            first_seen(stream, KEYS, within="1 hour").writeStream.format("parquet")
            .option("checkpointLocation", f"{out}/cp").trigger(availableNow=True).start(f"{out}/data")
        )
        query.awaitTermination()
    assert sorted(r.at for r in spark.read.parquet(f"{out}/data").collect()) == [5, 10**8, 10**9]


def _dedupe_operators(spark, source, out, schema, spread):
    stream = first_seen(spark.readStream.schema(schema).parquet(source), KEYS, spread)
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/cp")
        .trigger(availableNow=True).start(f"{out}/data")
    )
    query.awaitTermination()
    return [operator for operator in query.lastProgress["stateOperators"] if operator["operatorName"] == "dedupe"]


def test_hot_key_is_combined_before_the_shuffle(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    _rows(spark, 0, 6000).write.parquet(source)
    (last,) = _dedupe_operators(spark, source, out, "k string, at long, v double", 4)
    keys = spark.read.parquet(f"{out}/data").count()
    assert last["numRowsTotal"] == keys
    # six input files, so at most six rows of any key get through
    assert last["customMetrics"]["numDroppedDuplicateRows"] <= 5 * keys


def test_hot_key_with_a_variant_is_sliced(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    _rows(spark, 0, 6000).withColumn("v", F.parse_json(F.lit("1"))).write.parquet(source)
    last, sliced = _dedupe_operators(spark, source, out, "k string, at long, v variant", 4)
    keys = spark.read.parquet(f"{out}/data").count()
    assert last["numRowsTotal"] == keys
    assert last["customMetrics"]["numDroppedDuplicateRows"] <= 3 * keys
    assert sliced["customMetrics"]["numDroppedDuplicateRows"] >= 6000 - 4 * keys


@pytest.mark.parametrize("remember", [1, 1000])
def test_combining_keeps_the_first_row_of_every_key(spark, remember):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        i = F.col("id")
        rows = spark.range(0, 2000, 1, 2).select(
            F.when(i % 3 == 0, F.lit("hot")).when(i % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), i % 301)).alias("k"),
            F.timestamp_seconds(i % 2).alias("at"),
            i.alias("v"),
            F.spark_partition_id().alias("task"),
        )
        combined = combine_copies(rows, KEYS, remember).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    everything = rows.toPandas()
    first = everything.sort_values("v").groupby(["task", *KEYS], dropna=False, as_index=False).first()
    assert set(first["v"]) <= set(combined["v"]) <= set(everything["v"])
    assert combined["v"].is_unique
    if remember == 1000:
        hot = combined[combined["k"] == "hot"]
        assert len(hot) == 4  # two tasks, two times


def test_lowest_by_matches_pandas(spark):
    rows = _rows(spark, 0, 500)
    picked = lowest_by(rows, KEYS, ["v"]).toPandas().sort_values(KEYS).reset_index(drop=True)
    expected = rows.toPandas().sort_values("v").groupby(KEYS, as_index=False).first()
    pd.testing.assert_frame_equal(picked, expected.sort_values(KEYS).reset_index(drop=True)[picked.columns], check_dtype=False)


def test_lowest_by_carries_variants_and_nulls(spark):
    rows = spark.sql("""
        SELECT * FROM VALUES (1, 2, parse_json('{"a":2}')), (1, 1, parse_json('{"a":1}')), (NULL, 5, NULL) AS t(k, o, v)
    """)
    found = {row["k"]: (row["o"], str(row["v"])) for row in lowest_by(rows, ["k"], ["o"]).collect()}
    assert found == {1: (1, '{"a":1}'), None: (5, "None")}
