"""Contract-name functions (column expressions, JVM side).

A contract name ``DddHHQn`` encodes the weekly delivery slot: weekday, hour and
quarter of the hour (``Tue11Q4`` = Tuesday 11:45).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday abbreviations in Monday=0 order.
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delivery_weekday(name) -> Column:
    """Weekday (Mon=0) of the delivery slot, NULL for an unknown prefix."""
    day = F.substring(_col(name), 1, 3)
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), day).cast("int") - 1


def parse_contract(name) -> Column:
    """struct(dow, hour, minute) of ``DddHHQn``; fields NULL when the name does not parse.

    Character 6 (the ``Q``) is not checked, like the original parser; the quarter is the tail.
    """
    n = _col(name)
    dow = delivery_weekday(n)
    hour = F.expr("try_cast(substring({0}, 4, 2) AS INT)".format(_sql(n)))
    quarter = F.expr("try_cast(substring({0}, 7) AS INT)".format(_sql(n)))
    ok = (dow >= 0) & hour.between(0, 23) & quarter.between(1, 4)
    return F.when(ok, F.struct(
        dow.alias("dow"), hour.alias("hour"), ((quarter - 1) * 15).alias("minute")
    ))


def _sql(c: Column) -> str:
    # column name for embedding into a SQL snippet
    return c._jc.toString()


def contract_name_for_int(k) -> Column:
    """Fixture naming rule: integer k -> one of the 7*24*4 = 672 contract names.

    j = (k*263) mod 672; weekday = j mod 7, hour = (j div 7) mod 24, quarter = j div 168 + 1.
    """
    j = F.pmod(_col(k).cast("long") * 263, F.lit(672))
    day = F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), (j % 7 + 1).cast("int"))
    hour = F.lpad(((j / 7).cast("long") % 24).cast("string"), 2, "0")
    quarter = ((j / 168).cast("long") + 1).cast("string")
    return F.concat(day, hour, F.lit("Q"), quarter)


def next_delivery(ts, dow, hour, minute) -> Column:
    """next delivery instant strictly after ``ts`` for a weekly slot (dow, hour, minute).

    midnight(ts) + ((dow - weekday(ts) + 7) mod 7) days + hh:mm; if that is <= ts, add 7 days.
    """
    t = _col(ts)
    days_ahead = F.pmod(_col(dow) - F.weekday(t) + 7, F.lit(7))
    midnight = F.date_trunc("day", t)
    cand = (midnight
            + F.make_dt_interval(days_ahead, _col(hour), _col(minute), F.lit(0)))
    return F.when(cand <= t, cand + F.expr("INTERVAL 7 DAYS")).otherwise(cand)


def hours_between(later, earlier) -> Column:
    """(later - earlier) in hours as DOUBLE."""
    return (F.unix_micros(_col(later)) - F.unix_micros(_col(earlier))) / F.lit(3.6e9)


def time_to_delivery(ts, dow, hour, minute) -> Column:
    """hours until the next delivery, clipped at 0; range (0, 168]."""
    return F.greatest(hours_between(next_delivery(ts, dow, hour, minute), ts), F.lit(0.0))
