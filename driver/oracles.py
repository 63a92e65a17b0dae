"""SQL twins of the queries, computed from the raw tables without any JSON."""

from __future__ import annotations

from driver.queries import BATCH_ID, DEVICE
from driver.views import AUDIT_FAULTS, DEVICES, HARDWARE, INSTRUCTION_SETS, LINE_FORMS, PAYLOAD_FAULTS, READING_FAULTS, RUN_ID, SENSOR_TYPES


def _has(name: str) -> str:
    return f"(event_id % {({**READING_FAULTS, **PAYLOAD_FAULTS})[name]} = 0)"


def _pick(values: tuple[str, ...]) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], CAST(user_id % {len(values)} + 1 AS BIGINT))"


_HARDWARE_NAME = _pick(tuple(name for name, _ in HARDWARE))
_IDENTIFIER = _pick(tuple(identifier for _, identifier in HARDWARE))
_LABEL = f"{_HARDWARE_NAME} || ' ' || {_IDENTIFIER}"
_SENSOR_TYPE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SENSOR_TYPES.items()) + " END"
_TESTED_AT = "TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(user_id AS INTEGER))"

# One row per delivered payload, with what a parser should find in it.
_PAYLOADS = f"""
ev AS (
  SELECT e.event_id, e.user_id, e.event_type, e.value, date_trunc('millisecond', e.ts) AS ts,
         CAST(e.ts AS DATE) AS upload_date, CAST(e.props ->> 'k' AS DOUBLE) AS load, c.copy
  FROM events e JOIN (VALUES (1), (2)) c(copy) ON c.copy = 1 OR e.event_id % 5 = 0
),
shape AS (
  SELECT *,
    'landing/ingest_date=' || upload_date || '/part-' || copy || '-' || (user_id % 4) || '.json' AS source_file,
    {_has("extra_key")} AS extra_top,
    {_has("extra_metadata_key")} AND NOT {_has("extra_key")} AND NOT {_has("null_metadata")} AS extra_meta,
    {_has("broken_line")} AND NOT {_has("extra_key")} AND NOT {_has("extra_metadata_key")} AS broken,
    NOT {_has("extra_key")} AND NOT {_has("extra_metadata_key")} AND NOT {_has("broken_line")}
      AND NOT {_has("wrong_shape")} AND NOT {_has("no_snapshots")} AND NOT {_has("empty_snapshots")} AS free
  FROM ev
),
found AS (
  SELECT *,
    broken OR {_has("null_metadata")} AS no_metadata,
    {_has("extra_reading_key")} AND free AS extra_reading,
    NOT broken AND {_has("wrong_shape")} OR {_has("wrong_element")} AND NOT {_has("extra_reading_key")} AND free AS mistyped,
    NOT extra_top AND NOT extra_meta AND NOT broken AND NOT (free AND ({_has("extra_reading_key")} OR {_has("wrong_element")})) AS plain,
    CASE WHEN NOT plain THEN NULL WHEN {_has("repeated_key")} THEN CASE WHEN free THEN 'repeated_key' END
         WHEN {_has("repeated_reading_key")} THEN CASE WHEN free THEN 'repeated_reading_key' END
         WHEN {_has("trailing_text")} THEN 'trailing_text' END AS lossy,
    extra_top OR extra_meta OR extra_reading OR mistyped OR lossy IS NOT NULL AS rescued,
    broken AS corrupt,
    CASE WHEN broken OR {_has("wrong_shape")} OR {_has("no_snapshots")} OR mistyped THEN NULL
         WHEN {_has("empty_snapshots")} THEN 0 ELSE 2 END AS n_snapshots
  FROM shape
),
judged AS (
  SELECT *,
    CASE WHEN no_metadata OR {_has("null_test")} THEN NULL ELSE 'u' || user_id END AS test_id,
    CASE WHEN no_metadata OR {_has("null_device")} THEN NULL ELSE 'id_' || (user_id % {DEVICES}) END AS device_id,
    CASE WHEN {_has("bad_test_date")} THEN NULL ELSE {_TESTED_AT} END AS tested_at,
    concat_ws(',',
      CASE WHEN no_metadata THEN 'null_metadata' END,
      CASE WHEN no_metadata OR {_has("null_device")} THEN 'null_metadata_device_id' END,
      CASE WHEN no_metadata OR {_has("null_test_date")} THEN 'null_metadata_test_date' END,
      CASE WHEN no_metadata OR {_has("null_test")} THEN 'null_metadata_test_id' END,
      CASE WHEN no_metadata OR {_has("null_software")} THEN 'null_metadata_testing_software' END,
      CASE WHEN no_metadata OR {_has("null_system")} THEN 'null_metadata_underlying_system' END,
      CASE WHEN n_snapshots IS NULL THEN 'null_snapshots' END,
      CASE WHEN n_snapshots = 0 THEN 'empty_snapshots' END,
      CASE WHEN rescued THEN 'rescued_data_present' END,
      CASE WHEN corrupt THEN 'corrupt_record_present' END) AS reasons
  FROM found
)"""

# Two rows per accepted payload, typed, with their reasons.
_READINGS = f"""{_PAYLOADS},
sent AS (
  SELECT test_id, device_id, tested_at, upload_date, source_file, user_id,
    CASE WHEN NOT {_has("null_hardware")} THEN {_LABEL} END AS hardware_name,
    CASE WHEN NOT {_has("null_sensor_name")} THEN event_type END AS sensor_name,
    CASE WHEN NOT {_has("null_sensor_type")} THEN {_SENSOR_TYPE} END AS sensor_type,
    CASE WHEN {_has("invalid_value")} THEN NULL WHEN {_has("nan_value")} THEN CAST('nan' AS DOUBLE)
         WHEN {_has("infinite_value")} THEN CAST('inf' AS DOUBLE) WHEN {_has("null_value")} THEN NULL
         ELSE value END AS sensor_value,
    CASE WHEN NOT {_has("bad_poll_time")} THEN ts END AS polled_at,
    {_has("invalid_value")} AS non_numeric
  FROM judged WHERE reasons = ''
  UNION ALL
  SELECT test_id, device_id, tested_at, upload_date, source_file, user_id,
    {_LABEL}, 'load', 'Load', load, ts, false
  FROM judged WHERE reasons = ''
),
readings AS (
  SELECT *, concat_ws(',',
      CASE WHEN tested_at IS NULL THEN 'null_test_date' END,
      CASE WHEN hardware_name IS NULL THEN 'null_hardware_name' END,
      CASE WHEN sensor_name IS NULL THEN 'null_sensor_name' END,
      CASE WHEN sensor_type IS NULL THEN 'null_sensor_type' END,
      CASE WHEN isnan(sensor_value) THEN 'nan_sensor_value' END,
      CASE WHEN sensor_value IS NULL THEN 'null_sensor_value' END,
      CASE WHEN isinf(sensor_value) THEN 'infinite_sensor_value' END,
      CASE WHEN polled_at IS NULL THEN 'null_polled_at' END) AS reasons
  FROM sent
),
fact AS (
  SELECT test_id, hardware_name, sensor_name, sensor_type, sensor_value, polled_at, source_file FROM (
    SELECT *, row_number() OVER (
      PARTITION BY test_id, hardware_name, sensor_name, sensor_type, polled_at
      ORDER BY source_file, sensor_value) AS place
    FROM readings WHERE reasons = '')
  WHERE place = 1
),
tests AS (
  SELECT test_id, min(tested_at) AS tested_at, min(device_id) AS device_id, min(user_id) AS user_id
  FROM readings WHERE reasons = '' GROUP BY test_id
)"""

# The same tables without JSON and faults.
_FLAT = f"""
fact AS (
  SELECT 'u' || user_id AS test_id, {_LABEL} AS hardware_name, event_type AS sensor_name,
    {_SENSOR_TYPE} AS sensor_type, value AS sensor_value, date_trunc('millisecond', ts) AS polled_at,
    'landing/ingest_date=' || CAST(ts AS DATE) || '/part-1-' || (user_id % 4) || '.json' AS source_file,
    user_id, CAST(ts AS DATE) AS upload_date
  FROM events
),
tests AS (
  SELECT DISTINCT 'u' || user_id AS test_id, {_TESTED_AT} AS tested_at, 'id_' || (user_id % {DEVICES}) AS device_id, user_id
  FROM events
)"""


def _mart(interval: str) -> str:
    return f"""
mart AS (
  SELECT s.test_id, t.tested_at, t.device_id, 'device_' || (t.user_id % {DEVICES}) AS testing_software,
    s.hardware_name, s.sensor_name, s.sensor_type, s.sensor_value, s.polled_at,
    CASE WHEN s.polled_at < min(s.polled_at) OVER (PARTITION BY s.test_id) + INTERVAL {interval}
         THEN TRUE ELSE FALSE END AS thermal_rampup_phase, t.user_id
  FROM fact s JOIN tests t ON s.test_id = t.test_id
  WHERE 'device_' || (t.user_id % {DEVICES}) = '{DEVICE}'
)"""


_MART_ROWS = "SELECT * EXCLUDE (user_id) FROM mart"

_RATIOS = f"""WITH {_FLAT}, {_mart("'10' MINUTE")},
averaged AS (
  SELECT test_id, date_trunc('day', polled_at) + INTERVAL 0 DAY AS bucket_start,
    'core_' || (user_id % {len(HARDWARE)}) AS core,
    CASE WHEN user_id % {len(HARDWARE)} < 2 THEN 'large' ELSE 'compact' END AS core_type,
    {_pick(INSTRUCTION_SETS)} AS instruction_set,
    avg(sensor_value) FILTER (WHERE sensor_name IN ('click', 'error')) AS watts,
    avg(sensor_value) FILTER (WHERE sensor_name = 'view') AS mhz
  FROM mart WHERE NOT thermal_rampup_phase AND sensor_name IN ('click', 'error', 'view')
  GROUP BY ALL
),
ratios AS (
  SELECT *, watts / mhz AS watts_per_mhz FROM averaged WHERE watts IS NOT NULL AND mhz <> 0
)"""

# Every field is known here, so only values of the wrong type are left to rescue.
_EVOLVED = f"""{_PAYLOADS},
wider AS (
  SELECT CASE WHEN copy = 2 AND NOT broken THEN event_id % 7 END AS site,
    CASE WHEN copy = 2 AND NOT no_metadata THEN 'r1' END AS rack,
    CASE WHEN copy = 2 AND n_snapshots > 0 THEN CAST(3 AS BIGINT) END AS phase,
    mistyped OR lossy IS NOT NULL AS mistyped, trim(replace(',' || reasons || ',',
      CASE WHEN mistyped OR lossy IS NOT NULL THEN ' ' ELSE ',rescued_data_present,' END, ','), ',') AS reasons
  FROM judged
)"""
_LACKING = ", ".join(
    f"CASE WHEN event_id % {modulus} = 0 THEN 'null_{name}' END" for name, modulus in AUDIT_FAULTS.items()
)

ORACLES = {
    "landing_parse": f"""WITH {_PAYLOADS}
        SELECT coalesce(test_id, '(none)') AS test_id, count(*) AS payloads, count(device_id) AS with_device,
          CAST(coalesce(sum(n_snapshots), 0) AS BIGINT) AS readings
        FROM judged GROUP BY 1""",
    "rescued_keys": f"""WITH {_PAYLOADS}
        SELECT upload_date AS adls_upload_date,
          CASE WHEN extra_top THEN 'collector' WHEN extra_meta THEN 'metadata.firmware' ELSE 'snapshots.unit' END
            AS unexpected_key, count(*) AS payloads
        FROM judged WHERE extra_top OR extra_meta OR extra_reading GROUP BY 1, 2""",
    "rescued_reading_keys": f"""WITH {_PAYLOADS}
        SELECT event_id, copy, 'snapshots.unit' AS unexpected_keys, 'W' AS kept_unit FROM judged WHERE extra_reading""",
    "rescued_types": f"""WITH {_PAYLOADS}
        SELECT event_id, copy, true AS readable FROM judged WHERE mistyped AND NOT extra_top AND NOT extra_meta""",
    "rescued_lines": f"""WITH {_PAYLOADS}
        SELECT event_id, copy, lossy AS fault, true AS whole FROM judged WHERE lossy IS NOT NULL""",
    "line_forms": f"""WITH {_PAYLOADS},
        formed AS (
          SELECT *, CASE WHEN event_id % {LINE_FORMS["array"]} = 0 AND NOT broken THEN 2 ELSE 1 END AS times FROM judged)
        SELECT coalesce(test_id, '(none)') AS test_id, sum(times)::BIGINT AS payloads,
          (count(*) FILTER (WHERE corrupt))::BIGINT AS corrupt,
          CAST(coalesce(sum(times * n_snapshots), 0) AS BIGINT) AS readings
        FROM formed GROUP BY 1""",
    "corrupt_records": f"""WITH {_PAYLOADS}
        SELECT upload_date AS adls_upload_date, count(*) FILTER (WHERE corrupt) AS corrupt, count(*) AS payloads
        FROM judged GROUP BY 1""",
    "audit_columns": f"""
        SELECT event_id, CAST(ts AS DATE) AS adls_upload_date, 'events.parquet' AS source_name,
          '{RUN_ID}' AS execution_id, true AS ingested FROM events""",
    "inferred_columns": f"""WITH {_PAYLOADS}
        SELECT 'collector' AS column_name, 'string' AS column_type FROM judged WHERE extra_top HAVING count(*) > 0""",
    "payload_reasons": f"""WITH {_PAYLOADS}
        SELECT event_id, copy, reasons FROM judged WHERE reasons <> ''""",
    "audit_reasons": f"""WITH {_PAYLOADS},
        lacking AS (
          SELECT event_id, copy, concat_ws(',', nullif(reasons, ''), {_LACKING}) AS reasons FROM judged)
        SELECT * FROM lacking WHERE reasons <> ''""",
    "payload_split_counts": f"""WITH {_PAYLOADS}
        SELECT upload_date AS adls_upload_date, CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS side,
          count(*) AS payloads FROM judged GROUP BY 1, 2""",
    "explode_flatten_cast": f"""WITH {_READINGS}
        SELECT test_id, device_id, 'monitor' AS underlying_system, tested_at, hardware_name, sensor_name, sensor_type,
          CASE WHEN isfinite(sensor_value) THEN sensor_value END AS sensor_value, polled_at, source_file
        FROM readings""",
    "accepted_readings": f"""WITH {_READINGS}
        SELECT device_id, test_id, tested_at, 'monitor' AS underlying_system,
          'device_' || (user_id % {DEVICES}) AS device, hardware_name, sensor_name, sensor_type, sensor_value,
          polled_at, upload_date AS adls_upload_date, source_file, '{RUN_ID}' AS execution_id
        FROM readings WHERE reasons = ''""",
    "reading_reasons": f"""WITH {_READINGS}
        SELECT test_id, source_file, hardware_name, sensor_name, polled_at, reasons FROM readings WHERE reasons <> ''""",
    "non_numeric_values": f"""WITH {_READINGS}
        SELECT concat_ws(',', nullif(reasons, ''), CASE WHEN non_numeric THEN 'non_numeric_sensor_value' END) AS reasons,
          count(*) AS readings
        FROM readings WHERE reasons <> '' GROUP BY 1""",
    "quarantine_envelope": f"""WITH {_PAYLOADS}
        SELECT event_id, copy, test_id, CAST(n_snapshots AS INTEGER) AS snapshots, source_file, corrupt, rescued,
          '{BATCH_ID}' AS quarantined_batch_id, true AS stamped, reasons
        FROM judged WHERE reasons <> ''""",
    "reasons_by_stage": f"""WITH {_READINGS},
        given AS (
          SELECT 'incoming' AS stage, unnest(string_split(reasons, ',')) AS reason FROM judged WHERE reasons <> ''
          UNION ALL
          SELECT 'outgoing', unnest(string_split(reasons, ',')) FROM readings WHERE reasons <> '')
        SELECT reason, count(*) AS rows, stage FROM given GROUP BY reason, stage""",
    "fct_dedup": f"WITH {_READINGS} SELECT * FROM fact",
    "tests_dedup": f"""WITH {_READINGS}
        SELECT test_id, tested_at, device_id, 'device_' || (user_id % {DEVICES}) AS device,
          'monitor' AS underlying_system FROM tests""",
    "files_dedup": f"""WITH {_READINGS}
        SELECT DISTINCT source_file, upload_date AS adls_upload_date, '{RUN_ID}' AS execution_id
        FROM readings WHERE reasons = ''""",
    "lineitem_dedup": """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS place
          FROM lineitem) WHERE place = 1""",
    "lineage_join": f"""WITH {_FLAT}
        SELECT test_id, sensor_name, polled_at, sensor_value, source_file, upload_date AS adls_upload_date,
          '{RUN_ID}' AS execution_id FROM fact""",
    "hardware_identity": f"""
        SELECT event_id, {_LABEL} AS hardware_name, {_HARDWARE_NAME} AS model, {_IDENTIFIER} AS identifier FROM events""",
    "hardware_classes": f"""WITH {_FLAT}
        SELECT test_id, hardware_name,
          list_extract(['cpu', 'gpu_amd', 'gpu_nvidia', 'memory'], CAST(user_id % 5 + 1 AS BIGINT)) AS hardware_class,
          sensor_name, sensor_value, polled_at FROM fact WHERE user_id % 5 < 4""",
    "gpu_readings": f"""WITH {_FLAT}
        SELECT CASE user_id % 5 WHEN 1 THEN 'gpu_amd' ELSE 'gpu_nvidia' END AS hardware_class, sensor_name,
          count(*) AS readings, round(sum(sensor_value), 2) AS total
        FROM fact WHERE user_id % 5 IN (1, 2) GROUP BY 1, 2""",
    "poll_time_text": """
        SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y%m%d_%H%M%S%g') AS timestamp FROM events""",
    "payload_roundtrip": f"""WITH {_FLAT},
        single AS (
          SELECT * FROM (SELECT *, row_number() OVER (
            PARTITION BY test_id, hardware_name, sensor_name, sensor_type, polled_at
            ORDER BY source_file, sensor_value) AS place FROM fact) WHERE place = 1)
        SELECT s.test_id, strftime(t.tested_at, '%Y%m%d_%H%M%S') AS test_date, count(*) AS readings,
          round(sum(sensor_value), 2) AS total, min(strftime(polled_at, '%Y%m%d_%H%M%S%g')) AS first_poll,
          max(strftime(polled_at, '%Y%m%d_%H%M%S%g')) AS last_poll, true AS within_limit
        FROM single s JOIN tests t ON s.test_id = t.test_id GROUP BY 1, 2""",
    "device_filter_variant": f"""WITH {_FLAT}
        SELECT test_id, tested_at, device_id FROM tests WHERE 'device_' || (user_id % {DEVICES}) = '{DEVICE}'""",
    "first_poll_per_test": f"""WITH {_FLAT}
        SELECT DISTINCT test_id, min(polled_at) OVER (PARTITION BY test_id) AS started_at FROM fact""",
    "device_mart_10m": f"""WITH {_FLAT}, {_mart("'10' MINUTE")} {_MART_ROWS}""",
    "device_mart_1d": f"""WITH {_FLAT}, {_mart("'1' DAY")} {_MART_ROWS}""",
    "device_mart_shuffled": f"""WITH {_FLAT}, {_mart("'1' DAY")} {_MART_ROWS}""",
    "landing_to_mart": f"""WITH {_READINGS}, {_mart("'1' DAY")} {_MART_ROWS}""",
    "test_settings": f"""WITH {_FLAT}
        SELECT test_id, device_id, 'device_' || (user_id % {DEVICES}) AS device, 'Laptop' AS device_type,
          'M' || (user_id % 3) AS model, 'CPU' AS configuration, CAST(user_id % 50 + 10 AS INTEGER) AS length_in_minutes,
          'Extreme' AS mode, 'Variable' AS load_type, CAST(1 AS INTEGER) AS start_at_cycle,
          {_pick(INSTRUCTION_SETS)} AS instruction_set, 'Fixed' AS thread_settings,
          CAST(user_id % 24 + 1 AS INTEGER) AS thread_count FROM tests""",
    "steady_state": f"""WITH {_FLAT}, {_mart("'1' DAY")}
        SELECT test_id, sensor_name, sensor_value, polled_at FROM mart WHERE NOT thermal_rampup_phase""",
    "steady_state_stats": f"""WITH {_FLAT}, {_mart("'1' DAY")}
        SELECT test_id, hardware_name, sensor_name, sensor_type, count(*) AS readings,
          round(avg(sensor_value), 6) AS mean_value, round(stddev_samp(sensor_value), 6) AS stddev_value,
          round(stddev_samp(sensor_value) / nullif(avg(sensor_value), 0), 6) AS variation,
          round(regr_slope(sensor_value, (epoch_ms(polled_at) - epoch_ms(tested_at)) / 3600000.0), 6) AS drift_per_hour,
          min(sensor_value) AS lowest, max(sensor_value) AS highest
        FROM mart WHERE NOT thermal_rampup_phase GROUP BY 1, 2, 3, 4""",
    "efficiency_ratio": f"""{_RATIOS}
        SELECT test_id, bucket_start, core, core_type, instruction_set, round(watts, 6) AS watts,
          round(mhz, 6) AS mhz, round(watts_per_mhz, 6) AS watts_per_mhz FROM ratios""",
    "efficiency_summary": f"""{_RATIOS}
        SELECT core_type, instruction_set, count(*) AS buckets, round(avg(watts_per_mhz), 6) AS mean_ratio,
          round(stddev_samp(watts_per_mhz), 6) AS stddev_ratio,
          round(quantile_disc(watts_per_mhz, 0.05), 6) AS p05_ratio,
          round(quantile_disc(watts_per_mhz, 0.5), 6) AS p50_ratio,
          round(quantile_disc(watts_per_mhz, 0.95), 6) AS p95_ratio
        FROM ratios GROUP BY 1, 2""",
    "efficiency_compare": f"""{_RATIOS},
        sides AS (
          SELECT instruction_set, avg(watts_per_mhz) FILTER (WHERE core_type = 'large') AS a,
            avg(watts_per_mhz) FILTER (WHERE core_type = 'compact') AS b
          FROM ratios GROUP BY 1)
        SELECT instruction_set, round(a, 6) AS first_ratio, round(b, 6) AS second_ratio,
          round(a - b, 6) AS difference, round(a / b, 6) AS quotient FROM sides""",
    "medallion_counts": f"""WITH {_READINGS}
        SELECT count(*) AS rows, 'bronze' AS layer FROM judged
        UNION ALL SELECT count(*), 'fact' FROM fact
        UNION ALL SELECT count(*), 'tests' FROM tests
        UNION ALL SELECT count(*), 'incoming_quarantine' FROM judged WHERE reasons <> ''
        UNION ALL SELECT count(*), 'outgoing_quarantine' FROM readings WHERE reasons <> ''""",
    "medallion_fact": f"""WITH {_READINGS}
        SELECT test_id, hardware_name, sensor_name, sensor_type, polled_at, sensor_value FROM fact""",
    "medallion_mart": f"""WITH {_READINGS}, {_mart("'10' MINUTE")} {_MART_ROWS}""",
    "medallion_files": f"""WITH {_READINGS}
        SELECT DISTINCT upload_date AS adls_upload_date,
          CASE WHEN source_file LIKE '%part-1-%' THEN 'run-1' ELSE 'run-2' END AS execution_id
        FROM readings WHERE reasons = ''""",
    "medallion_tests": f"""WITH {_READINGS}
        SELECT test_id, tested_at, device_id, 'device_' || (user_id % {DEVICES}) AS testing_software,
          'monitor' AS underlying_system FROM tests""",
    "medallion_quarantine": f"""WITH {_READINGS}
        SELECT 'incoming' AS side, reasons, count(*) AS rows FROM judged WHERE reasons <> '' GROUP BY 2
        UNION ALL SELECT 'outgoing', reasons, count(*) FROM readings WHERE reasons <> '' GROUP BY 2""",
    "evolved_bronze": f"""WITH {_EVOLVED}
        SELECT site, rack, phase, mistyped AS rescued, count(*) AS payloads FROM wider GROUP BY ALL""",
    "evolved_managed_bronze": f"""WITH {_EVOLVED}
        SELECT site, rack, phase, mistyped AS rescued, count(*) AS payloads FROM wider GROUP BY ALL""",
    "evolved_quarantine": f"""WITH {_EVOLVED}
        SELECT site, rack, reasons, count(*) AS payloads FROM wider WHERE reasons <> '' GROUP BY ALL""",
}
