"""The half-open watermark window, its kinds, load types and commit time stamps."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.scalars import parse_numts

KINDS = ("NUMTS", "TIMESTAMPL", "DATE", "DATETIME", "INT")
LOAD_TYPES = ("D", "F", "I", "L")
FORM = "%Y%m%d%H%M%S"


@dataclass(frozen=True)
class Bounds:
    """floor is exclusive; as_of, for whole days, is an exclusive upper bound; next_watermark is what a success stores."""

    floor: str | None
    as_of: str | None
    next_watermark: str | None


def _moved(stamp: str, seconds: int) -> str:
    return (dt.datetime.strptime(stamp[:14], FORM) - dt.timedelta(seconds=seconds)).strftime(FORM)


def bounds(kind: str, watermark: str | None, safety: int, read_start: dt.datetime | None = None, staged_max: str | None = None, reload: bool = False) -> Bounds:
    """The window of one read.

    Clock kinds keep rows committed during a slow read: the next watermark is the start of the read less
    the safety, which bounds the watermark and not the read. DATE reads whole days before read_start's
    (a reload reads today as well) and rounds the safety up to days; INT goes back ``safety`` units, padding
    kept, and takes its next value from what was staged.
    """
    if kind == "CHANGENR":
        raise ValueError("change numbers are not in commit order and cannot be a watermark")
    if kind not in KINDS:
        raise ValueError(f"unknown watermark kind {kind}")
    if kind == "INT":
        low = None if watermark is None or reload else str(max(0, int(watermark) - safety)).zfill(len(watermark))
        return Bounds(low, None, forward(kind, watermark, staged_max))
    if read_start is None:
        raise ValueError("wall-clock kinds need the source's clock")
    if kind == "DATE":
        days = -(-safety // 86400)
        low = None if watermark is None or reload else (dt.datetime.strptime(watermark, "%Y%m%d") - dt.timedelta(days=days)).strftime("%Y%m%d")
        today = read_start.strftime("%Y%m%d")
        return Bounds(low, None if reload else today, forward(kind, watermark, (read_start - dt.timedelta(days=1)).strftime("%Y%m%d")))
    low = None if watermark is None or reload else _moved(watermark, safety) + (watermark[14:] if kind == "TIMESTAMPL" else "")
    top = _moved(read_start.strftime(FORM), safety) + (".0000000" if kind == "TIMESTAMPL" else "")
    return Bounds(low, None, forward(kind, watermark, top))


def forward(kind: str, before: str | None, after: str | None) -> str | None:
    """A watermark never moves back: counters by length then text, clocks by text."""
    given = [x for x in (before, after) if x is not None]
    if not given:
        return None
    return max(given, key=lambda x: (len(x.lstrip("0")), x.lstrip("0"))) if kind == "INT" else max(given)


def predicate(kind: str, b: Bounds, column: str, time_column: str | None = None) -> Column:
    """The read's condition on text columns; text is only ever compared with text, so Spark casts nothing."""
    out = F.lit(True)
    if b.floor is not None:
        if kind == "DATETIME":
            day, clock = b.floor[:8], b.floor[8:14]
            out = (F.col(column) > day) | ((F.col(column) == day) & (F.col(time_column) > clock))
        elif kind == "INT":
            own, low = F.col(column), b.floor
            out = F.lpad(own, 40, "0") > F.lit(low.zfill(40))
        else:
            out = F.col(column) > b.floor
    if b.as_of is not None:
        out = out & (F.col(column) < b.as_of)
    return out


def commit_ts(kind: str, column: str, time_column: str | None = None, skew_seconds: int = 0) -> Column:
    """When a row was committed at the source, on our clock; counters have no time."""
    skew = F.expr(f"interval {skew_seconds} seconds")
    if kind in ("NUMTS", "TIMESTAMPL"):
        return parse_numts(F.col(column).cast("string"))
    if kind == "DATETIME":
        return parse_numts(F.concat(F.col(column), F.col(time_column))) + skew
    if kind == "DATE":
        return parse_numts(F.concat(F.col(column), F.lit("000000"))) + skew
    return F.lit(None).cast("timestamp")


@dataclass(frozen=True)
class Plan:
    """What a load type does: read from the floor or all, truncate first, move the watermark."""

    reads: bool
    from_floor: bool
    truncates: bool
    advances: bool


def load_plan(load_type: str) -> Plan:
    """D delta, F full without moving the watermark, I nothing but the watermark, L full and move it."""
    return {"D": Plan(True, True, False, True), "F": Plan(True, False, True, False), "I": Plan(False, False, False, True), "L": Plan(True, False, True, True)}[load_type]


def check_target(kind: str, keys: list[str], cadence: str, load_type: str = "D", method: str = "WATERMARK") -> None:
    """Refuses what cannot work: no keys, days read more often than hourly, reloads of other methods."""
    if not keys:
        raise ValueError("a target that is merged needs keys")
    if kind == "DATE" and cadence.startswith("micro:") and int(cadence[6:]) < 3600:
        raise ValueError("whole days cannot be followed every few seconds")
    if load_type != "D" and method != "WATERMARK":
        raise ValueError(f"load type {load_type} is only for watermark targets")
