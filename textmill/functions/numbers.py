"""Arithmetic of the job farm: workers wanted, time budgets, idleness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill import constants as K


def ratio(n: Column) -> Column:
    """Tasks per worker: ``n`` where positive, else 1."""
    return F.when(n > 0, n).otherwise(F.lit(1)).cast("bigint")


def int_div(a: Column, n: Column) -> Column:
    """Integer division, exact for every BIGINT (a double is not)."""
    return F.call_function("div", a.cast("bigint"), n.cast("bigint"))


def ceil_div(a: Column, n: Column) -> Column:
    """``ceil(a / n)`` for integers and ``n > 0``."""
    return int_div(a, n) + F.when((a > 0) & (a % n != 0), 1).otherwise(0)


def clamp_workers(wanted: Column, cap: int) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.least(wanted.cast("bigint"), F.lit(cap).cast("bigint")))


def time_budget(visibility_s: Column) -> Column:
    """Seconds a task may run inside its visibility timeout."""
    return F.greatest(F.lit(K.MIN_BUDGET_S).cast("bigint"), visibility_s - F.lit(K.VISIBILITY_MARGIN_S))


def seconds_between(start: Column, end: Column) -> Column:
    return int_div(F.unix_micros(end) - F.unix_micros(start), F.lit(1_000_000))


def idle_minutes(last: Column, now: Column) -> Column:
    return int_div(F.unix_micros(now) - F.unix_micros(last), F.lit(60_000_000))
