"""Stand-in telemetry made from the driver's tables, its queries and their SQL twins."""
