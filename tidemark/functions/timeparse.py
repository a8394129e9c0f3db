"""Guide instants: text of 8 to 14 digits with an offset. The precision of a text survives every change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import once

_FORM = r"^\s*(\d{8})(\d{2})?(\d{2})?(\d{2})?\s*(?:([+-]\d{4})|(Z))(.*)$"


def _let(value: Column, then) -> Column:
    return F.element_at(F.transform(F.array(value), then), 1)


def _parsed(c: Column) -> Column:
    """Pieces of a text: digits, local (time without a zone), minutes (of the offset), offset (text), tail; nulls where it is malformed.

    24:00:00 is the next day's start, second 60 the next minute's.
    """
    names = ("day", "hour", "minute", "second", "offset", "z", "tail")
    # one match gives all pieces; what doesn't match has none
    listed = F.split(F.regexp_replace(c, _FORM, "|".join(f"${k + 1}" for k in range(len(names)))), r"\|", len(names))
    piece = lambda x, k: F.when(F.size(x) == len(names), F.coalesce(F.get(x, F.lit(k)), F.lit(""))).otherwise("")
    pieces = _let(listed, lambda x: F.struct(*[piece(x, k).alias(n) for k, n in enumerate(names)], F.rlike(c, F.lit(_FORM)).alias("ok")))
    number = lambda x, start=1: F.coalesce(F.substring(x, start, 2).try_cast("int"), F.lit(0))

    def numbers(p: Column) -> Column:
        return F.struct(p.alias("p"), number(p["hour"]).alias("h"), number(p["minute"]).alias("m"), number(p["second"]).alias("s"), number(p["offset"], 2).alias("oh"), number(p["offset"], 4).alias("om"), F.try_to_date(p["day"], "yyyyMMdd").cast("timestamp_ntz").alias("date"))

    def whole(x: Column) -> Column:
        p = x["p"]
        in_day = ((x["h"] == 24) & (x["m"] == 0) & (x["s"] == 0)) | ((x["h"] <= 23) & (x["m"] <= 59) & (x["s"] <= 60))
        local = F.when(p["ok"] & in_day, x["date"] + F.make_dt_interval(secs=x["h"] * 3600 + x["m"] * 60 + x["s"]))
        sign = F.when(F.startswith(p["offset"], F.lit("-")), -1).otherwise(1)
        minutes = F.when(p["z"] == "Z", 0).when((p["offset"] != "") & (x["oh"] <= 23) & (x["om"] <= 59), sign * (x["oh"] * 60 + x["om"]))
        return F.struct(F.length(F.concat(p["day"], p["hour"], p["minute"], p["second"])).alias("size"), local.cast("timestamp_ntz").alias("local"), minutes.alias("minutes"), F.when(p["z"] == "Z", F.lit("+0000")).otherwise(p["offset"]).alias("offset"), p["tail"].alias("tail"))

    return _let(pieces, lambda p: _let(numbers(p), whole))


@once
def local_time(c: Column) -> Column:
    """The digits as a time without a zone; null where the text isn't an instant."""
    return _parsed(c)["local"]


@once
def instant(c: Column) -> Column:
    """UTC time, without a zone; null where the text isn't an instant."""
    return _let(_parsed(c), lambda p: p["local"] - F.make_dt_interval(mins=p["minutes"]))


def _render(time: Column, size: Column) -> Column:
    return F.substr(F.date_format(time, "yyyyMMddHHmmss"), F.lit(1), size)


@once
def shift(c: Column, minutes: Column) -> Column:
    """The text moved by minutes, in its own zone and precision; malformed or 0: as it is."""

    def moved(p: Column) -> Column:
        text = F.concat(_render(p["local"] + F.make_dt_interval(mins=minutes), p["size"]), F.lit(" "), p["offset"], p["tail"])
        return F.when((F.coalesce(minutes, F.lit(0)) == 0) | p["local"].isNull() | p["minutes"].isNull(), c).otherwise(text)

    return _let(_parsed(c), moved)


@once
def convert(c: Column, zone: str) -> Column:
    """The text in another zone, with its offset then; malformed: as it is."""

    def offset_of(x: Column) -> Column:
        return F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("+")), F.lpad((F.abs(x) / 60).cast("int").cast("string"), 2, "0"), F.lpad((F.abs(x) % 60).cast("string"), 2, "0"))

    def moved(x: Column) -> Column:
        text = F.concat(_render(x["there"], x["size"]), F.lit(" "), _let(F.timestamp_diff("MINUTE", x["utc"], x["there"]), offset_of))
        return F.when(x["utc"].isNull(), c).otherwise(text)

    def at(p: Column) -> Column:
        return _let(p["local"] - F.make_dt_interval(mins=p["minutes"]), lambda utc: _let(F.struct(utc.alias("utc"), F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).alias("there"), p["size"].alias("size")), moved))

    return _let(_parsed(c), at)


@once
def date_is_fresh(c: Column, today: Column, past: int = 2, future: int = 21) -> Column:
    """Whether the local calendar date lies within past days before and future days after today."""
    day = F.try_to_date(F.substring(F.trim(c), 1, 8), "yyyyMMdd")
    return F.coalesce(day.between(F.date_sub(today, past), F.date_add(today, future)), F.lit(False))


@once
def is_usable(start: Column, stop: Column, now: Column, past_hours: int = 6, future_hours: int = 48) -> Column:
    """Whether a programme (times without a zone) ended at most past_hours ago and starts at most future_hours ahead."""
    ended = F.coalesce(stop < now - F.make_dt_interval(hours=F.lit(past_hours)), F.lit(False))
    return F.coalesce(~ended & (start <= now + F.make_dt_interval(hours=F.lit(future_hours))), F.lit(False))


@once
def lenient(c: Column) -> Column:
    """Three forms, perhaps without an offset; for durations only."""
    text = F.trim(c)
    bare = F.try_to_timestamp(F.substring(text, 1, 14), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")
    return F.coalesce(instant(text), bare, F.try_to_timestamp(F.substring(text, 1, 12), F.lit("yyyyMMddHHmm")).cast("timestamp_ntz"))


@once
def duration_minutes(start: Column, stop: Column) -> Column:
    """Whole minutes from start to stop, at least 0; null where either can't be read."""
    return F.greatest(F.lit(0).cast("long"), F.timestamp_diff("MINUTE", start, stop))
