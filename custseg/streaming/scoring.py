"""Stateless scoring of a streaming DataFrame: the batch function, which adds a column in place and
therefore needs neither state nor a join."""

from ..operators.score import score as score_stream

__all__ = ["score_stream"]
