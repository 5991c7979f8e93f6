"""Where rows come from and where they are kept: OTLP/JSON payloads and day-partitioned Parquet tables."""
