"""Taxi pickups per window: filter, fixed window, one pane when the watermark passes, then
one per late row with the grown (accumulated) count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flumen import schemas
from flumen.operators.panes import ACCUMULATING
from flumen.streaming.fired import window_panes


def parse(messages: DataFrame, text_col: str = "value") -> DataFrame:
    """JSON ride messages -> typed columns (other columns kept)."""
    keep = [c for c in messages.columns if c != text_col]
    return messages.select(*keep, F.from_json(F.col(text_col), schemas.TAXI).alias("r")).select(*keep, "r.*")


def pickups_per_window(rides: DataFrame, ts: str, size: str = "60 seconds",
                       lateness_s: int = 60, status: str = "pickup") -> DataFrame:
    """Pickups per event-time window; the watermark is taken over every ride
    (as a message source's watermark would be), not only over pickups."""
    return window_panes(rides, ts, size, lateness_s, mode=ACCUMULATING, only=F.col("ride_status") == status)
