"""Sensor-telemetry lakehouse on Apache Spark.

Landing payloads -> bronze (raw + audit) -> silver (validated fact, two
dimensions, two quarantines) -> gold (per-device mart with a ramp-up flag).
Every transformation maps a DataFrame to a DataFrame and works on a stream
and on a batch alike; sinks are kept apart in :mod:`rampline.streaming`.
"""
