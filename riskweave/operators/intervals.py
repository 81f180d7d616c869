"""Interval (range) joins: rows of ``left`` paired with rows of ``right``
that share the equi key and whose time lies in ``[right_ts + lower,
right_ts + upper]`` (both ends inclusive).

Two physical shapes, same rows:

* ``plain``   – equi join on the key with the range as a residual predicate.
  Spark plans a sort-merge join on the key alone, so one heavy key puts all of
  its rows in one task and the residual is checked for every pair of that key.
* ``bucketed`` (default) – a time bucket of width ``upper - lower`` is added to
  the equi key.  Each right row is copied only to the buckets its window
  touches (at most two); each left row keeps its single bucket, so the
  preserved side of a left join is never duplicated and every pair is
  produced exactly once.  A heavy key is spread over its time buckets and
  only pairs at most two windows apart are ever compared; AQE's skew-join
  split handles a bucket that is still large.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT_US = {
    "microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000,
}


#: Buckets a right row's window may touch.
MAX_BUCKETS = 64


def interval_micros(text: str) -> int:
    """Length of an interval literal such as ``"1 hour"`` or ``"-30 minutes"``."""
    m = re.fullmatch(r"\s*(-?\d+)\s+([a-zA-Z]+?)s?\s*", text)
    if not m or m.group(2).lower() not in _UNIT_US:
        raise ValueError(f"unsupported interval: {text!r}")
    return int(m.group(1)) * _UNIT_US[m.group(2).lower()]


def _micros_sql(col: str) -> str:
    return f"unix_micros(CAST(`{col}` AS TIMESTAMP))"


def _floor_div_sql(expr: str, width: int) -> str:
    """Exact floor division of a BIGINT expression by a positive constant."""
    return f"(({expr}) - pmod(({expr}), {width}L)) div {width}L"


def micros(ts: str) -> Column:
    return F.expr(_micros_sql(ts))


def floor_div(column: str, width: int) -> Column:
    """Exact floor division of a BIGINT column by a positive constant."""
    return F.expr(_floor_div_sql(f"`{column}`", width))


def time_bucket(ts: str, width: int) -> Column:
    """Bucket (of ``width`` microseconds) of a row's own time."""
    return F.expr(_floor_div_sql(_micros_sql(ts), width))


def window_buckets(ts: str, lo_us: int, hi_us: int, width: int) -> Column:
    """Buckets that ``[ts + lo_us, ts + hi_us]`` touches: two at most where the
    bucket is as wide as the window."""
    return F.sequence(F.expr(_floor_div_sql(f"{_micros_sql(ts)} + {lo_us}L", width)),
                      F.expr(_floor_div_sql(f"{_micros_sql(ts)} + {hi_us}L", width)))


def bucket_width(lo_us: int, hi_us: int, bucket: str | None) -> int:
    width = interval_micros(bucket) if bucket else max(hi_us - lo_us, 1)
    if width <= 0 or (hi_us - lo_us) // width + 2 > MAX_BUCKETS:
        raise ValueError(f"bucket {bucket!r} is too narrow for a window of {hi_us - lo_us} microseconds")
    return width


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  lower: str = "0 seconds", upper: str = "1 hour", how: str = "left",
                  strategy: str = "bucketed", bucket: str | None = None) -> DataFrame:
    """Join ``left`` to ``right`` on ``key`` and ``right_ts + lower <= left_ts <= right_ts + upper``.

    ``left`` and ``right`` must not share column names other than ``key``; the
    result carries ``key`` once (from ``left``), as a USING join does.  A
    ``bucket`` so narrow that a window would touch more than ``MAX_BUCKETS`` of
    them is an error: each right row is copied once per bucket.
    """
    if how not in ("left", "inner"):
        raise ValueError("interval_join supports how='left' or 'inner'")
    lo_us, hi_us = interval_micros(lower), interval_micros(upper)
    if hi_us < lo_us:
        raise ValueError("upper must not be below lower")
    rk = f"__rk_{key}"
    r = right.withColumnRenamed(key, rk)
    lt_us, rt_us = F.expr(_micros_sql(left_ts)), F.expr(_micros_sql(right_ts))
    in_range = (lt_us >= rt_us + F.lit(lo_us)) & (lt_us <= rt_us + F.lit(hi_us))

    if strategy == "plain":
        return left.join(r, (F.col(key) == F.col(rk)) & in_range, how).drop(rk)
    if strategy != "bucketed":
        raise ValueError(f"unknown strategy {strategy!r}")

    width = bucket_width(lo_us, hi_us, bucket)
    lb, rb = "__lb", "__rb"
    l2 = left.withColumn(lb, time_bucket(left_ts, width))
    r2 = r.withColumn(rb, F.explode(window_buckets(right_ts, lo_us, hi_us, width)))
    cond = (F.col(key) == F.col(rk)) & (F.col(lb) == F.col(rb)) & in_range
    return l2.join(r2, cond, how).drop(rk, lb, rb)
