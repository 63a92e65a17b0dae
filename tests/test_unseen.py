import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rampline.contracts import FACT_KEY
from rampline.naming import Layout
from rampline.operators import clustering
from rampline.operators.gold import device_mart
from rampline.streaming import unseen
from rampline.streaming.unseen import add_unseen, append_unseen

START = datetime(2026, 1, 2, 3, 4)
SCHEMA = (
    "test_id string, hardware_name string, sensor_name string, sensor_type string, "
    "sensor_value double, polled_at timestamp, source_file string"
)


def _reading(test, second, value=1.0, sensor="s", file="f"):
    return (test, "hw", sensor, "Load", value, START + timedelta(seconds=second), file)


@pytest.fixture(params=["managed", "external"])
def table(request, spark, tmp_path):
    name = f"unseen_{tmp_path.name.replace('-', '_')}"
    yield name, None if request.param == "managed" else str(tmp_path / "table")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _keys(spark, name):
    return sorted((row.test_id, row.polled_at) for row in spark.table(name).select("test_id", "polled_at").collect())


def test_only_new_keys_are_added(spark, table):
    name, path = table

    def add(*rows):
        return add_unseen(spark.createDataFrame(rows, SCHEMA), name, FACT_KEY, path, by_test=True)

    assert add(_reading("a", 1), _reading("a", 1, 2.0), _reading("a", 2), _reading("b", 1)) == 3
    assert add(_reading("a", 1, 9.0), _reading("b", 2), _reading("c", 1)) == 2
    assert add() == 0
    assert add(*[_reading("hot", k % 40) for k in range(400)]) == 40
    assert add(_reading("hot", 39), _reading("hot", 40), _reading("a", 1, sensor="other")) == 2
    assert spark.table(name).count() == len(set(_keys(spark, name))) + 1 == 47


def _stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def _deliver(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _folder_bytes(folder):
    return sum(file.stat().st_size for file in Path(folder).rglob("*") if file.is_file())


def test_no_state_grows_over_runs(spark, table, tmp_path):
    name, path = table
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    sizes = []
    for run in range(10):
        _deliver(spark, source, [_reading(f"t{run % 3}", k) for k in range(run * 50, run * 50 + 100)])
        append_unseen(_stream(spark, source), name, checkpoint, FACT_KEY, path, by_test=True).awaitTermination()
        sizes.append(_folder_bytes(checkpoint))
        assert not (Path(checkpoint) / "state").exists()
    # each run adds its offsets and its source files, as every stream does
    assert max(b - a for a, b in zip(sizes, sizes[1:], strict=False)) < 4000
    want = {(f"t{run % 3}", k) for run in range(10) for k in range(run * 50, run * 50 + 100)}
    assert spark.table(name).count() == len(want)


def test_a_crash_between_write_and_commit_adds_nothing_twice(spark, table, tmp_path, monkeypatch):
    name, path = table
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    _deliver(spark, source, [_reading("a", k) for k in range(5)])
    real = unseen.add_unseen

    def dies(*args):
        real(*args)
        raise RuntimeError("planted")

    monkeypatch.setattr(unseen, "add_unseen", dies)
    with pytest.raises(Exception, match="planted"):
        append_unseen(_stream(spark, source), name, checkpoint, FACT_KEY, path, by_test=True).awaitTermination()
    assert spark.table(name).count() == 5 and not list((Path(checkpoint) / "commits").glob("[0-9]*"))
    monkeypatch.undo()
    _deliver(spark, source, [_reading("a", k) for k in range(3, 8)])
    for _ in range(2):  # a run that repeats a batch may end after it
        append_unseen(_stream(spark, source), name, checkpoint, FACT_KEY, path, by_test=True).awaitTermination()
    assert _keys(spark, name) == [("a", START + timedelta(seconds=k)) for k in range(8)]


def test_dimensions_with_variants(spark, table):
    name, path = table
    rows = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2")], "test_id string, v string").withColumn("v", F.parse_json("v"))
    assert add_unseen(rows, name, ["test_id"], path) == 2
    assert add_unseen(rows, name, ["test_id"], path) == 0
    assert {row[0] for row in spark.table(name).select(F.to_json("v")).collect()} == {"1", "2"}


def _files_read(df):
    """Files that the scans of an executed plan have read."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaves, waiting = [], [plan]
    while waiting:
        node = waiting.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
            waiting.append(node.plan())
        children = node.children()
        waiting += [children.apply(k) for k in range(children.length())]
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            leaves.append(node.metrics().apply("numFiles").value())
    return leaves


def test_one_device_reads_its_own_files(spark, table):
    name, path = table
    tests = [f"t{k}" for k in range(40)]
    add_unseen(
        spark.createDataFrame([_reading(test, k) for test in tests for k in range(20)], SCHEMA), name, FACT_KEY, path, by_test=True
    )
    dim = spark.createDataFrame(
        [(t, START, "id", json.dumps({"device": "mine" if t in ("t3", "t7") else "other"})) for t in tests],
        "test_id string, tested_at timestamp, device_id string, testing_software string",
    ).withColumn("testing_software", F.parse_json("testing_software"))
    mart = device_mart(spark.table(name), dim, "mine")
    assert {row.test_id for row in mart.collect()} == {"t3", "t7"} and mart.count() == 40
    files = spark.table(name).select(F.input_file_name()).distinct().count()
    read = _files_read(mart)
    assert len(read) <= 2 and max(read) <= 2 < 20 < files
    # the shuffled form prunes as well
    assert {row.test_id for row in device_mart(spark.table(name), dim, "mine", limit=0).collect()} == {"t3", "t7"}


def test_files_are_sorted_and_a_hot_test_is_cut_by_time(spark, table, monkeypatch):
    name, path = table
    monkeypatch.setattr(clustering, "ROWS_PER_FILE", 100)
    rows = [_reading("hot", k) for k in range(1000)] + [_reading(f"t{k}", k) for k in range(50)]
    add_unseen(spark.createDataFrame(rows, SCHEMA).repartition(4), name, FACT_KEY, path, by_test=True)
    spans = (
        spark.table(name).filter("test_id = 'hot'").groupBy(F.input_file_name().alias("file"))
        .agg(F.min("polled_at").alias("low"), F.max("polled_at").alias("high"), F.count("*").alias("n")).orderBy("low").collect()
    )
    assert len(spans) > 5 and max(span.n for span in spans) < 400
    assert all(a.high < b.low for a, b in zip(spans, spans[1:], strict=False))


def test_an_external_fact_is_found_again(spark, tmp_path):
    from rampline.streaming.stages import Pipeline, attach

    layout = Layout(root=str(tmp_path / "volumes"), table_root=str(tmp_path / "tables"))
    pipeline = Pipeline(layout=layout, bronze_schema="u_b", silver_schema="u_s", gold_schema="u_g", ops_schema="u_o")
    name, path = attach(spark, pipeline, "u_s", "fact"), layout.table_path("u_s", "fact")
    add_unseen(spark.createDataFrame([_reading(f"t{k}", k) for k in range(9)], SCHEMA), name, FACT_KEY, path, by_test=True)
    spark.sql(f"DROP TABLE {name}")
    assert spark.table(attach(spark, pipeline, "u_s", "fact")).count() == 9
    spark.sql("DROP SCHEMA u_s CASCADE")
