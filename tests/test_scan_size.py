from __future__ import annotations

import pytest

from rampline.naming import Layout
from rampline.session import bytes_per_scan_task
from rampline.streaming import stages

SIZE = "spark.sql.files.maxPartitionBytes"


def test_scans_in_here_are_cut_small_and_others_as_before(spark, tmp_path):
    spark.range(1000).coalesce(1).write.option("parquet.block.size", 1024).parquet(str(tmp_path / "ids"))
    before = spark.conf.get(SIZE)

    def splits():
        return spark.read.parquet(str(tmp_path / "ids")).rdd.getNumPartitions()

    usual = splits()
    with pytest.raises(ValueError), bytes_per_scan_task(spark, 512):
        assert splits() > usual
        raise ValueError
    assert splits() == usual and spark.conf.get(SIZE) == before


def test_silver_streams_start_with_small_scans(spark, tmp_path, monkeypatch):
    layout = Layout(root=str(tmp_path / "volumes"), table_root=str(tmp_path / "tables"))
    pipeline = stages.Pipeline(layout, "scan_bronze", "scan_silver", "scan_gold", "scan_ops")
    line = '{"metadata":{"underlying_system":"s","testing_software":{},"device_id":"d","test_id":"t","test_date":"20240101_000000"},"snapshots":[]}'
    spark.createDataFrame([(line,)], "value string").write.text(f"{pipeline.landing_path}/ingest_date=2024-01-01")
    stages.run_bronze(spark, pipeline, "run-1", infer_schema=False)
    seen, before, drain = [], spark.conf.get(SIZE), stages.drain

    def recorded(starters):
        seen.append(int(spark.conf.get(SIZE)))
        drain(starters)

    monkeypatch.setattr(stages, "drain", recorded)
    stages.run_silver(spark, pipeline)
    assert seen == [stages.SILVER_SCAN_BYTES]
    assert spark.conf.get(SIZE) == before
    assert spark.table(pipeline.quarantine(pipeline.incoming_quarantine)).count() == 1
