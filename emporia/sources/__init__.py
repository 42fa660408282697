"""Sources and sinks: parquet tables, JSON/Kafka streams, JDBC sync, layer writers."""

from emporia.sources.tables import TABLES, table  # noqa: F401
