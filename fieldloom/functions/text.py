"""Text, clock and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(text: Column) -> Column:
    """Lower case, every run of other characters than a-z and 0-9 as one underscore, none at the ends; empty: null."""
    out = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(out != "", out)


def is_snake(text: Column) -> Column:
    return text.rlike("^[a-z0-9]+(_[a-z0-9]+)*$")


def clock_seconds(text: Column) -> Column:
    """Seconds of ``MM:SS`` with any number of minutes and seconds up to 59; else null."""
    good = text.rlike("^[0-9]+:[0-5][0-9]$")
    return F.when(good, F.split(text, ":")[0].try_cast("int") * 60 + F.split(text, ":")[1].try_cast("int"))


def clock_ms(text: Column) -> Column:
    """Milliseconds of a time of day ``HH:MM[:SS[.fff]]``; else null (a time with a zone is none)."""
    shape = r"^([01]\d|2[0-3]):([0-5]\d)(?::([0-5]\d)(?:\.(\d{1,6}))?)?$"
    part = lambda i: F.regexp_extract(text, shape, i)
    n = lambda i: F.coalesce(F.when(part(i) != "", part(i).cast("long")), F.lit(0).cast("long"))
    ms = F.rpad(F.substring(part(4), 1, 3), 3, "0").cast("long")
    return F.when(text.rlike(shape), ((n(1) * 60 + n(2)) * 60 + n(3)) * 1000 + F.when(part(4) != "", ms).otherwise(F.lit(0).cast("long")))


def uuid_text(text: Column) -> Column:
    """Canonical lower-case form of a UUID written with or without hyphens or braces; else null."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(text), "^(urn:)?(uuid:)?", ""), "[{}-]", "")
    cut = [F.substring(bare, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(bare.rlike("^[0-9a-f]{32}$"), F.concat_ws("-", *cut))


def is_nil_uuid(text: Column) -> Column:
    return text == "00000000-0000-0000-0000-000000000000"


def is_sha256(text: Column) -> Column:
    return text.rlike("^[0-9a-f]{64}$")


def is_commit(text: Column) -> Column:
    return text.rlike("^[0-9a-f]{40}$")


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def finite(x: Column) -> Column:
    """``x``, or null where it is not a finite number."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def logit(p: Column, clip: float = 1e-7) -> Column:
    q = clamp(p, clip, 1 - clip)
    return F.ln(q / (1 - q))


def close(a: Column, b: Column, rel: float, absolute: float) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))


def kick_off(date: Column, time: Column) -> Column:
    """Start of a match; a missing time counts as midnight."""
    return F.to_timestamp_ntz(F.concat_ws(" ", date.cast("string"), F.coalesce(time, F.lit("00:00:00"))))


def one_hot_name(flags: dict[str, Column], unknown: str = "unknown") -> Column:
    """Name of the first true flag."""
    out = F.lit(unknown)
    for name, flag in reversed(list(flags.items())):
        out = F.when(flag, F.lit(name)).otherwise(out)
    return out
