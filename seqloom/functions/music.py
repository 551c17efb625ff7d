"""Numbers of the music domain as column expressions: bends, positions, channels, event fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bend_value(semitones: Column, bend_range: Column) -> Column:
    """14-bit pitch bend of an interval: centre 8192, clamped to the range, half to even."""
    share = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), semitones / bend_range))
    return F.greatest(F.lit(0), F.least(F.lit(16383), F.rint(8192 + share * 8191).cast("int")))


def bend_bytes(semitones: Column, bend_range: Column) -> Column:
    """struct<lsb, msb> of the bend, seven bits each."""
    v = bend_value(semitones, bend_range)
    return F.struct(v.bitwiseAND(127).alias("lsb"), F.shiftright(v, 7).alias("msb"))


def bar_of(tick: Column, ppq: Column, numerator: Column, denominator: Column) -> Column:
    """Bar from 1; a beat is the note that the signature's denominator names."""
    beats = (tick / ppq) / (F.lit(4.0) / denominator)
    return (F.floor(beats / numerator) + 1).cast("long")


def beat_of(tick: Column, ppq: Column, numerator: Column, denominator: Column) -> Column:
    """Beat in the bar, from 1, unrounded."""
    beats = (tick / ppq) / (F.lit(4.0) / denominator)
    return beats - F.floor(beats / numerator) * numerator + 1


def bar_beat(tick: Column, ppq: Column, numerator: Column, denominator: Column) -> Column:
    return F.concat_ws(".", bar_of(tick, ppq, numerator, denominator).cast("string"), F.format_string("%.2f", beat_of(tick, ppq, numerator, denominator)))


def melodic_channel(ix: Column) -> Column:
    """Channel of the ix-th part: fifteen in turn, leaving out 9, which is percussion's."""
    c = ix % 15
    return F.when(c >= 9, c + 1).otherwise(c)


def kind(status: Column) -> Column:
    return status.bitwiseAND(0xF0)


def channel(status: Column) -> Column:
    return status.bitwiseAND(0x0F)


def clock(seconds: Column) -> Column:
    """m:ss.mmm"""
    minutes = F.floor(seconds / 60)
    return F.format_string("%d:%06.3f", minutes.cast("long"), seconds - minutes * 60)
