"""Time as whole milliseconds, from and to the notations of subtitle files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parts(c: Column) -> tuple[Column, Column]:
    """Whole seconds, and the digits of the fraction."""
    t = F.translate(F.trim(c), ",-", ".:")
    hms = F.split(F.split_part(t, F.lit("."), F.lit(1)), ":")
    n = F.size(hms)
    field = lambda back: F.coalesce(F.get(hms, n - back).try_cast("long"), F.lit(0))
    return field(3) * 3600 + field(2) * 60 + field(1), F.split_part(t, F.lit("."), F.lit(2))


def to_ms(c: Column) -> Column:
    """H:MM:SS or MM:SS with a comma or dot before the fraction, which is read to three digits. Other text gives null."""
    seconds, fraction = _parts(c)
    ok = c.rlike("^\\s*(\\d+[:\\-])?\\d{1,2}[:\\-]\\d{1,2}([.,]\\d+)?\\s*$")
    return F.when(ok, seconds * 1000 + F.rpad(F.substring(fraction, 1, 3), 3, "0").cast("long"))


def to_seconds(c: Column) -> Column:
    """Seconds as a double, in any of the notations of to_ms; 0.0 for other text."""
    return F.coalesce(to_ms(c) / F.lit(1000.0), F.lit(0.0))


def ass_to_ms(c: Column) -> Column:
    """A dot before the fraction means hundredths, a comma thousandths."""
    seconds, fraction = _parts(c)
    hundredths = F.rpad(F.substring(fraction, 1, 2), 2, "0").cast("long") * 10
    return seconds * 1000 + F.when(c.contains(","), F.rpad(F.substring(fraction, 1, 3), 3, "0").cast("long")).otherwise(hundredths)


def _pieces(ms: Column) -> list[Column]:
    ms = F.greatest(ms.cast("long"), F.lit(0))
    return [F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000]


def srt_time(ms: Column, mark: str = ",") -> Column:
    """HH:MM:SS,mmm"""
    h, m, s, f = _pieces(ms)
    return F.format_string(f"%02d:%02d:%02d{mark}%03d", h, m, s, f)


def ass_time(ms: Column) -> Column:
    """H:M:SS.cc; minutes have no leading zero."""
    h, m, s, f = _pieces(ms)
    return F.format_string("%d:%d:%02d.%02d", h, m, s, F.floor(f / 10))


def overlap_ms(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Length of the common part; 0 where intervals touch, negative where they are apart, null if a bound is null."""
    known = s1.isNotNull() & e1.isNotNull() & s2.isNotNull() & e2.isNotNull()
    return F.when(known, F.least(e1, e2) - F.greatest(s1, s2))


def overlap_ratio(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Common part over the length of the first interval, which counts as 1 ms at least."""
    return F.greatest(overlap_ms(s1, e1, s2, e2), F.lit(0)) / F.greatest(e1 - s1, F.lit(1))
