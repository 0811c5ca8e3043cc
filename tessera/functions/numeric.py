"""Numeric column functions over arrays and epochs.

All are built-in expressions: array math uses ``transform``/``aggregate``
on the row's own array, epochs use ``unix_seconds``/``timestamp_seconds``
under the session's UTC time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: UTC text format of the replication logs.
UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda s, x: s + x)


def log_sum_exp(logits: Column) -> Column:
    """``ln sum exp(x)``, shifted by the row maximum so large logits cannot overflow."""
    m = F.array_max(logits)
    return m + F.log(_sum(F.transform(logits, lambda x: F.exp(x - m))))


def softmax(logits: Column) -> Column:
    """Row-stable softmax of a numeric array."""
    m = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - m))
    s = _sum(e)
    return F.transform(e, lambda x: x / s)


def cross_entropy(logits: Column, target: Column) -> Column:
    """``-ln softmax(logits)[target]`` with a 0-based target index."""
    return log_sum_exp(logits) - F.element_at(logits, target.cast("int") + 1)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 UTC (floor), for TIMESTAMP or TIMESTAMP_NTZ."""
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_to_utc_text(epoch: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch), UTC_FORMAT)


def utc_text_to_timestamp(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit(UTC_FORMAT))
