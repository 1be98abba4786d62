"""Structured Streaming variants of the click operators (incremental CTR, scoring)."""

from clickspark.streaming.ctr import consolidate_changelog, file_stream, hourly_ctr_stream, run_hourly_ctr
from clickspark.streaming.scoring import score_stream

__all__ = ["consolidate_changelog", "file_stream", "hourly_ctr_stream", "run_hourly_ctr", "score_stream"]
