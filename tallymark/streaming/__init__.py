"""Streams."""

from tallymark.streaming.advantage import advantage_stream, with_advantages
from tallymark.streaming.report import report_stream, running_rejects, running_report
from tallymark.streaming.score import line_stream, score_lines, score_stream

__all__ = [
    "advantage_stream",
    "line_stream",
    "report_stream",
    "running_rejects",
    "running_report",
    "score_lines",
    "score_stream",
    "with_advantages",
]
