import uuid

import pytest

from rampline import cli
from tests.fixtures import land
from tests.test_silver import EXAMPLE


@pytest.mark.parametrize("stage", list(cli.REQUIRED))
def test_each_option_is_required_before_a_session_starts(stage, monkeypatch):
    monkeypatch.setattr(cli, "get_session", lambda: pytest.fail("session started"))
    for left_out in cli.REQUIRED[stage]:
        given = [part for name in cli.REQUIRED[stage] if name != left_out for part in (f"--{name}", "x")]
        with pytest.raises(SystemExit) as stopped:
            cli.main([stage, *given])
        assert stopped.value.code == 2


@pytest.mark.parametrize("argv", [[], ["copper"]])
def test_unknown_stage(argv):
    with pytest.raises(SystemExit) as stopped:
        cli.main(argv)
    assert stopped.value.code == 2


def test_three_stages(spark, tmp_path):
    tag = f"c{uuid.uuid4().hex[:8]}"
    places = ["--root", str(tmp_path / "volumes"), "--table-root", str(tmp_path / "tables")]
    options = {
        "catalog": "spark_catalog",
        "bronze-schema": f"{tag}_bronze",
        "landing-volume": "landing",
        "bronze-table": "readings",
        "silver-schema": f"{tag}_silver",
        "silver-sensors-table": "fct_sensors",
        "silver-dbx-metadata-table": "dim_dbx_metadata",
        "silver-tests-table": "dim_hardware_tests",
        "gold-schema": f"{tag}_gold",
        "ops-schema": f"{tag}_ops",
        "ops-volume": "operations",
        "inc-quarantine-table": "rejected_payloads",
        "out-quarantine-table": "rejected_readings",
        "pipeline-run-id": "r1",
    }
    land(spark, f"{tmp_path}/volumes/spark_catalog/{tag}_bronze/landing/incoming", *EXAMPLE)

    def stage(name, *more):
        cli.main([name, *(p for o in cli.REQUIRED[name] for p in (f"--{o}", options[o])), *places, *more])
        # a stage of its own process would not know the tables of the others
        for part in ("bronze", "silver", "gold", "ops"):
            spark.sql(f"DROP SCHEMA IF EXISTS {tag}_{part} CASCADE") if name != "gold" else None

    stage("bronze")
    stage("silver")
    stage("gold", "--device", "box")
    mart = spark.table(f"{tag}_gold.{cli.DEFAULT_MART}")
    assert sorted(row[0] for row in mart.select("thermal_rampup_phase").collect()) == [False, True]
    rejected = spark.read.parquet(f"{tmp_path}/tables/spark_catalog/{tag}_ops/rejected_payloads")
    assert rejected.count() == 2


def test_default_device(spark):
    args = cli.build_parser().parse_args(["gold", "--catalog", "c", "--silver-schema", "s", "--gold-schema", "g"])
    pipeline = cli.pipeline_of(args)
    assert pipeline.mart() == "c.g.mart_proart_p16_h7606wv"
    assert args.device == "ASUS_ProArt_P16_(H7606)"
    assert pipeline.silver(pipeline.fact_table) == "c.s.fct_sensors"
