"""Sources and sinks: schema'd readers, line formats, markup, versioned files, provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    """df, or a ValueError that names the missing columns, before any action runs."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
