"""Rational time, rounding, back-off, pitches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gcd(a: Column, b: Column, steps: int = 48) -> Column:
    """Greatest common divisor of positive longs, by folding Euclid's step over a fixed sequence."""
    start = F.struct(a.cast("long").alias("x"), b.cast("long").alias("y"))
    out = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        start,
        lambda s, _: F.when(s["y"] == 0, s).otherwise(F.struct(s["y"].alias("x"), F.try_mod(s["x"], s["y"]).alias("y"))),
    )
    return out["x"]


def rational(num: Column, den: Column) -> Column:
    """num / den in lowest terms, as struct(num, den)."""
    g = gcd(F.abs(num), den)
    return F.struct((num / g).cast("long").alias("num"), (den / g).cast("long").alias("den"))


def quarter(x: Column) -> Column:
    """Rounded to quarters, halves to even."""
    return F.bround(x * 4) / 4


def backoff(base: float, attempt: Column, most: float) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt - 1), F.lit(most))


def midi_number(step: Column, alter: Column, octave: Column, transpose: Column) -> Column:
    """MIDI number of a written pitch."""
    place = F.create_map(*(F.lit(v) for kv in zip("CDEFGAB", (0, 2, 4, 5, 7, 9, 11)) for v in kv))
    return ((octave + 1) * 12 + place[step] + alter + transpose).cast("int")
