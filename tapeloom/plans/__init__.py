"""Compositions: the query hub, the fluent pipeline, jobs, incremental planning and data quality."""
