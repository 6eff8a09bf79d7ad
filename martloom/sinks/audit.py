"""Columns that say when, from where and by which version a row was written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _now(as_of: dt.datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def add_audit(
    df: DataFrame,
    endpoint: str | Column,
    batch_id: str,
    version: str,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """The seven ingestion columns. ``as_of`` replaces the clock for repeatable runs."""
    now = _now(as_of)
    return df.withColumns(
        {
            "batch_id": F.lit(batch_id),
            "ingested_at": now,
            "updated_at": now,
            "source_endpoint": endpoint if isinstance(endpoint, Column) else F.lit(endpoint),
            "pipeline_version": F.lit(version),
            "ano_ingestao": F.year(now),
            "mes_ingestao": F.month(now),
        }
    )


def stamp(
    df: DataFrame,
    version: str,
    as_of: dt.datetime | None = None,
    layer: str | None = None,
    system: str | None = None,
) -> DataFrame:
    """``updated_at`` and ``pipeline_version``, optionally source layer and system."""
    columns = {"updated_at": _now(as_of), "pipeline_version": F.lit(version)}
    if layer is not None:
        columns["source_layer"] = F.lit(layer)
    if system is not None:
        columns["source_system"] = F.lit(system)
    return df.withColumns(columns)
