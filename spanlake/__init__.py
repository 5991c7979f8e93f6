"""Telemetry analytics (logs, spans, metrics) expressed as Spark DataFrame jobs."""

from spanlake.session import configure
from spanlake.store import SignalStore

__all__ = ["SignalStore", "configure"]
