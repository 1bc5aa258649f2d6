"""Shared definitions for the registered queries on the driver tables.

The driver tables hold no NULLs, so queries induce them with CASE/NULLIF
exactly as their SQL oracle does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.dates import minute_trunc
from martforge.functions.rules import code_map
from martforge.sources.io import read_table

# Event type -> campaign medium used to induce NULL media.
MEDIUM_OF_EVENT = {"purchase": "cpc", "click": "organic", "signup": "newsletter"}


def events(spark: SparkSession, sf_dir: str, cols=("event_id", "ts", "user_id", "event_type", "value")) -> DataFrame:
    return read_table(spark, sf_dir, "events", list(cols))


def medium_of_event(col="event_type") -> Column:
    """Campaign medium per event type; NULL for the other types."""
    return code_map(col, MEDIUM_OF_EVENT)


def event_day(col="ts") -> Column:
    return F.to_date(F.col(col))


def minute_chunk(col="ts") -> Column:
    """Chunk column for segmented scans: the event-time minute (non-decreasing in time order)."""
    return minute_trunc(col)
