"""Token settlement as a stream: four-hour windows in event time."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ridewright.operators import settlement
from ridewright.streaming.run import timed

DEFAULT_DELAY = "10 minutes"


def transfers(messages: DataFrame, delay: str = DEFAULT_DELAY, ticks: DataFrame | None = None) -> DataFrame:
    """Net transfers of each closed window; messages later than ``delay`` are dropped.

    A window's rows appear once, when the watermark passes its end; ``ticks`` close it while no messages come.
    """
    return settlement.settlement_batch(timed(messages, "ts", delay, ticks))
