from pyspark.sql import functions as F

from rampline import contracts
from rampline.operators.silver import clean, normalize, normalize_cleaned
from rampline.plans.reports import reason_report, with_lineage
from tests.fixtures import bronze_rows, payload, snapshot

EXAMPLE = [
    payload(
        snapshot("40.0", "20260102_030400000"),
        snapshot("41.0", "20260102_031400000"),
        snapshot("invalid", "20260102_031500000"),
    ),
    payload(device_id=None),
    {**payload(), "snapshots": []},
]


def test_example(spark):
    cleaned = clean(bronze_rows(spark, *EXAMPLE))
    fact, tests, files = normalize_cleaned(cleaned)
    assert (fact.count(), tests.count(), files.count()) == (2, 1, 1)
    incoming = {row[0] for row in reason_report(cleaned.incoming_quarantine).collect()}
    assert incoming == {"null_metadata_device_id", "empty_snapshots"}
    assert cleaned.outgoing_quarantine.first()["quarantine"] == ["null_sensor_value"]


def test_output_columns_and_types(spark):
    cleaned = clean(bronze_rows(spark, payload()))
    assert {f.name: f.dataType for f in cleaned.readings.schema} == {f.name: f.dataType for f in contracts.reading_schema()}
    fact, tests, files = normalize(cleaned.readings)
    assert tuple(fact.columns) == contracts.FACT_COLUMNS
    assert tuple(tests.columns) == contracts.TESTS_COLUMNS
    assert tuple(files.columns) == contracts.FILES_COLUMNS
    row = cleaned.readings.select(F.col("polled_at").cast("string"), F.col("tested_at").cast("string"), "sensor_value").first()
    assert tuple(row) == ("2026-01-02 03:04:05.006", "2026-01-02 03:04:00", 40.0)


def test_dimensions_need_an_accepted_reading(spark):
    documents = [
        payload(snapshot("x"), snapshot(None), test_id="all_bad"),
        payload(snapshot("x"), snapshot("1"), test_id="some_good"),
        payload(test_id="bad_date", test_date="never"),
        {**payload(test_id="null_element"), "snapshots": [None]},
    ]
    cleaned = clean(bronze_rows(spark, *documents))
    assert [row["test_id"] for row in normalize_cleaned(cleaned).tests.collect()] == ["some_good"]


def test_payload_dimensions_equal_reading_dimensions(spark):
    documents = [
        payload(*(snapshot(v, f"20260102_0304{i:02d}000") for i, v in enumerate(values)), test_id=f"t{n % 5}")
        for n, values in enumerate([["1", "x"], ["x"], ["NaN", "2"], [], ["Infinity"], ["3"], [None, "4"]] * 3)
    ]
    for document in documents[::4]:
        document["metadata"]["test_date"] = "never"
    rows = bronze_rows(spark, *documents).withColumn("source_file", F.concat(F.lit("f"), F.col("metadata.test_id")))
    cleaned = clean(rows)
    ours, theirs = normalize_cleaned(cleaned), normalize(cleaned.readings)
    for mine, other in zip(ours[1:], theirs[1:], strict=True):
        key = mine.columns[0]
        assert sorted(r[0] for r in mine.select(key).collect()) == sorted(r[0] for r in other.select(key).collect())
        assert mine.columns == other.columns
    assert sorted(map(str, ours.fact.collect())) == sorted(map(str, theirs.fact.collect()))


def test_strict_numbers_name_the_cause(spark):
    rows = bronze_rows(spark, payload(snapshot("x"), snapshot(None), snapshot("1")))
    strict = clean(rows, strict_numbers=True)
    found = sorted(row[0] for row in strict.outgoing_quarantine.select("quarantine").collect())
    assert found == [["null_sensor_value"], ["null_sensor_value", "non_numeric_sensor_value"]]
    assert "sensor_value_text" not in strict.outgoing_quarantine.select("quarantined_rows.*").columns
    assert strict.readings.count() == clean(rows).readings.count() == 1


def test_lineage(spark):
    tables = normalize_cleaned(clean(bronze_rows(spark, payload(), payload(test_id="t2"))))
    joined = with_lineage(tables.fact, tables.files)
    assert joined.count() == 2
    assert {"adls_upload_date", "execution_id", "dbx_ingested_at"} < set(joined.columns)
