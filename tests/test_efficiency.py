import numpy as np
import pytest
from pyspark.sql import functions as F

from rampline.plans import efficiency, percentiles


def _mart(spark):
    i = F.col("id")
    return spark.range(0, 2400, 1, 4).select(
        F.concat(F.lit("t"), i % 3).alias("test_id"),
        F.timestamp_millis(F.lit(1_767_000_000_000)).alias("tested_at"),
        F.parse_json(
            F.concat(F.lit('{"occt":{"stability_test":{"instruction_set":"I'), i % 3 % 2, F.lit('"}}}'))
        ).alias("testing_software"),
        F.lit("CPU").alias("hardware_name"),
        F.concat(F.element_at(F.array(F.lit("power "), F.lit("clock ")), (i % 2 + 1).cast("int")), F.floor(i / 2) % 4).alias("sensor_name"),
        F.lit("any").alias("sensor_type"),
        (F.pmod(F.hash("id"), F.lit(1000)) + 1.0).alias("sensor_value"),
        F.timestamp_millis(F.lit(1_767_000_000_000) + i * 500).alias("polled_at"),
        (i < 100).alias("thermal_rampup_phase"),
    )


def _mapping(spark):
    rows = [("CPU", f"{m} {n}", m, f"c{n}", "large" if n < 2 else "compact") for m in ("power", "clock") for n in range(4)]
    return spark.createDataFrame(rows, "hardware_name string, sensor_name string, metric string, core string, core_type string")


def _expected_ratios(spark):
    rows = _mart(spark).drop("testing_software").toPandas().query("not thermal_rampup_phase")
    rows[["metric", "core"]] = rows["sensor_name"].str.split(" ", expand=True)
    rows["bucket"] = rows["polled_at"].dt.floor("1min")
    means = rows.pivot_table(index=["test_id", "bucket", "core"], columns="metric", values="sensor_value", aggfunc="mean")
    means = means.dropna().reset_index()
    means["ratio"] = means["power"] / means["clock"]
    means["core_type"] = np.where(means["core"].astype(int) < 2, "large", "compact")
    means["instruction_set"] = "I" + (means["test_id"].str[1:].astype(int) % 2).astype(str)
    return means


def test_ratios_match_pandas(spark):
    ratios = efficiency.core_ratios(_mart(spark), _mapping(spark), "1 minute").toPandas()
    expected = _expected_ratios(spark)
    assert len(ratios) == len(expected) > 50
    mine = ratios.sort_values(["test_id", "bucket_start", "core"])["watts_per_mhz"].to_numpy()
    theirs = expected.sort_values(["test_id", "bucket", "core"])["ratio"].to_numpy()
    np.testing.assert_allclose(mine, theirs)


def test_summary_and_comparison_match_pandas(spark):
    ratios = efficiency.core_ratios(_mart(spark), _mapping(spark), "1 minute")
    expected = _expected_ratios(spark).groupby(["core_type", "instruction_set"])["ratio"]
    for row in efficiency.efficiency_summary(ratios).collect():
        group = expected.get_group((row["core_type"], row["instruction_set"])).sort_values().to_numpy()
        assert row["buckets"] == len(group)
        assert row["mean_ratio"] == pytest.approx(group.mean())
        assert row["stddev_ratio"] == pytest.approx(group.std(ddof=1))
        assert row["p50_ratio"] == pytest.approx(group[int(np.ceil(0.5 * len(group))) - 1])
    means = expected.mean()
    for row in efficiency.efficiency_comparison(ratios, "large", "compact").collect():
        first, second = means["large", row["instruction_set"]], means["compact", row["instruction_set"]]
        assert row["difference"] == pytest.approx(first - second)
        assert row["quotient"] == pytest.approx(first / second)


def test_stability_matches_numpy(spark):
    rows = _mart(spark).drop("testing_software").toPandas().query("not thermal_rampup_phase")
    found = efficiency.stability(_mart(spark)).collect()
    assert len(found) == rows.groupby(["test_id", "sensor_name"]).ngroups
    for row in found[:5]:
        group = rows[(rows["test_id"] == row["test_id"]) & (rows["sensor_name"] == row["sensor_name"])]
        values = group["sensor_value"].to_numpy()
        hours = (group["polled_at"] - group["tested_at"]).dt.total_seconds().to_numpy() / 3600
        assert row["readings"] == len(values)
        assert row["drift_per_hour"] == pytest.approx(np.polyfit(hours, values, 1)[0], rel=1e-6)
        assert row["variation"] == pytest.approx(values.std(ddof=1) / values.mean())
        assert (row["lowest"], row["highest"]) == (values.min(), values.max())


def test_idle_clock_has_no_ratio(spark):
    mart = _mart(spark).withColumn(
        "sensor_value", F.when(F.col("sensor_name").startswith("clock"), 0.0).otherwise(F.col("sensor_value"))
    )
    assert efficiency.core_ratios(mart, _mapping(spark)).count() == 0


def _wanted(rows, shares):
    """By group, the percentiles of its values in numpy's order, which has not-a-number last."""
    found = {}
    for group in {g for g, v in rows if v is not None}:
        own = np.sort([v for g, v in rows if g == group and v is not None])
        found[group] = [own[max(1, int(np.ceil(p * len(own)))) - 1] for p in shares]
    return found


def test_percentiles_are_exact(spark):
    random = np.random.default_rng(5)
    rows = [(g, float(v)) for g in ("a", None) for v in random.lognormal(0, 3, 2000)]
    rows += [("wide", float(s * 10.0**e)) for s, e in zip(random.choice([-1, 1], 300), random.uniform(-307, 307, 300), strict=True)]
    rows += [("tiny", float(v) * 5e-324) for v in random.integers(-(10**6), 10**6, 200)]
    rows += [("odd", float(v)) for v in (np.inf, -np.inf, np.nan, 0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, np.finfo(float).max, 1.0)]
    rows += [("powers", s * 2.0**e) for e in range(-1074, 1024, 13) for s in (1.0, -1.0)]
    rows += [("near", float(np.nextafter(2.0**e, to))) for e in range(-1020, 1023, 31) for to in (0.0, np.inf)]
    rows += [("ties", 1.5)] * 40 + [("one", -2.0), ("null", None), ("a", None), ("inf", np.inf), ("inf", np.inf), ("inf", 1.0)]
    frame = spark.createDataFrame(rows, "g string, v double")
    shares = (0.0, 0.05, 0.3, 0.5, 0.95, 1.0)
    found = {}
    for row in percentiles.exact_percentiles(frame, ["g"], "v", shares).collect():
        found.setdefault(row.g, {})[row.share] = row.value
    want = _wanted(rows, shares)
    assert found.keys() == want.keys()
    for group, values in want.items():
        np.testing.assert_array_equal([found[group][share] for share in shares], values, err_msg=str(group))


def test_bits_sort_as_values_do(spark):
    random = np.random.default_rng(6)
    values = random.integers(-(2**63), 2**63, 20_000, dtype=np.int64).view(np.float64)
    values = values[~np.isnan(values)].tolist() + [0.0, np.inf, -np.inf, 5e-324, 2.0**-1022, np.nextafter(2.0**-1022, 0)]
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    bits = {row.v: row.b for row in frame.select("v", percentiles.sortable_bits(F.col("v")).alias("b")).collect()}
    want = {v: int(np.abs(np.float64(v)).view(np.int64)) * (-1 if v < 0 else 1) for v in values}
    assert bits == want


def test_percentiles_take_as_many_rounds_for_any_values(spark, monkeypatch):
    written = []
    monkeypatch.setattr(percentiles, "_kept", lambda df, kept=percentiles._kept: written.append(1) or kept(df))
    for values in ([1.0, 2.0], [1e-300, 1.0, 1e297] * 20, [float("inf"), 1.0]):
        frame = spark.createDataFrame([("g", v) for v in values], "g string, v double")
        percentiles.exact_percentiles(frame, ["g"], "v", (0.5,)).collect()
    assert len(written) == 3 * percentiles.ROUNDS
