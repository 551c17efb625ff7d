"""Gesture detection on small parts, at 480 ticks a quarter note."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqloom.operators import gestures
from seqloom.operators.gestures import Part, bend, detect, replacement, short_notes, small_figures
from seqloom.sources import projects

STEP, LONG = 20, 480


def ramp(t, p, n, way=1, step=STEP, dur=16):
    return [(t + i * step, t + i * step + dur, p + way * i) for i in range(n)]


def part(rows, bpm=120, ppq=480):
    s = 60 / bpm / ppq
    df = pd.DataFrame([{"start": a, "end": b, "pitch": p, "velocity": 95, "channel": 0, "start_s": a * s, "end_s": b * s, "ppq": ppq, "note_ix": i} for i, (a, b, p) in enumerate(rows)])
    return Part.of(df)


def one(rows, **k):
    glides, skipped = detect(part(rows, **k))
    assert len(glides) == 1 and not skipped, (glides, skipped)
    return glides[0]


def test_slide_in():
    g = one([*ramp(0, 60, 9), (180, 660, 69)])
    assert (g["shape"], g["kind"], g["pitches"], g["bend_from"], g["bend_to"]) == ("bare", "slide-in", [69], -9, 0)


def test_slide_out():
    g = one(ramp(0, 75, 9, -1))
    assert (g["shape"], g["kind"], g["pitches"], g["bend_from"], g["bend_to"]) == ("bare", "slide-out", [75], 0, -8)


@pytest.mark.parametrize("rows", [ramp(0, 60, 10, step=100, dur=100), [(i * 20, i * 20 + 16, 60 + i % 2) for i in range(10)], [(0, 480, 55), *[(480 + 60 * i, 540 + 60 * i, 57 + d) for i, d in enumerate((0, 2, 4, 5, 7, 9, 11, 12))]]])
def test_played_notes(rows):
    assert not detect(part(rows))[0]


def test_faster_than_a_chord():
    g = one([*ramp(0, 51, 6, step=5, dur=5), (30, 510, 57)])
    assert (g["kind"], g["pitches"]) == ("slide-in", [57])


@pytest.mark.parametrize("bpm", [56, 120, 200])
def test_any_tempo(bpm):
    g = one([*ramp(0, 60, 6, step=30, dur=30), (180, 660, 66)], bpm=bpm)
    assert (g["pitches"], g["bend_from"]) == ([66], -6)


def test_ghost_of_a_held_note():
    g = one([(0, 864, 62), *ramp(480, 61, 6, -1, step=64, dur=64)])
    assert (g["shape"], g["pitches"], g["bend_to"], len(g["drop"])) == ("anchored", [62], -6, 7)


def test_parallel():
    g = one([*ramp(0, 48, 9), *[(a + 2, b + 2, p) for a, b, p in ramp(0, 55, 9)]])
    assert (g["shape"], g["pitches"], g["bend_from"], g["bend_to"], len(g["drop"])) == ("parallel", [48, 55], 0, 8, 18)


def test_anchored():
    g = one([(0, 700, 52), (2, 702, 59), *ramp(680, 51, 9, -1), *ramp(680, 58, 9, -1)])
    assert (g["shape"], g["pitches"], g["bend_to"], g["glide_start"], len(g["drop"])) == ("anchored", [52, 59], -9, 680, 20)


def test_obstruction():
    glides, skipped = detect(part([*ramp(0, 60, 9), (180, 660, 69), (0, 660, 40)]))
    assert not glides and [s["reason"] for s in skipped] == ["polyphonic"]


def test_hold_slide_hold():
    g = one([(0, 200, 55), (2, 202, 62), *ramp(200, 54, 4, -1), *ramp(200, 61, 4, -1), (280, 760, 50), (280, 760, 57)])
    assert (g["shape"], g["pitches"], g["bend_to"]) == ("anchored", [55, 62], -5)


def test_up_then_down():
    glides, _ = detect(part([*ramp(0, 53, 8), *ramp(160, 59, 8, -1)]))
    assert [(g["pitches"], np.sign(g["bend_to"])) for g in glides] == [([53], 1), ([59], -1)]


def test_fuller_landing():
    g = one([(0, 300, 52), *ramp(200, 51, 4, -1), (280, 680, 47), (282, 682, 54)])
    assert (g["shape"], g["pitches"], g["bend_to"], len(g["drop"])) == ("anchored", [52], -5, 5)


def test_least_span():
    g = one([(0, 300, 69), *ramp(200, 68, 4, -1)])
    assert (g["pitches"], g["bend_to"]) == ([69], -4)


def test_chord_is_one_cluster():
    assert [c.tolist() for c in part([(0, 480, 48), (2, 480, 55), (4, 480, 60)]).chords] == [[0, 1, 2]]


def test_isolated_sliver():
    hits = short_notes(part([(0, 480, 60), (480, 495, 45), (1380, 1860, 62)]))
    assert [h["pitches"] for h in hits] == [[45]] and hits[0]["duration_s"] < 0.03 < 0.08 < hits[0]["gap_after_s"]
    assert [h["pitches"] for h in short_notes(part([(0, 480, 60), (480, 495, 45), (482, 497, 52), (1380, 1860, 62)]))] == [[45, 52]]


def test_small_figure():
    hits = small_figures(part([(0, 480, 60), (0, 480, 64), (480, 520, 59), (480, 520, 63), (520, 560, 58), (520, 560, 62)]), set())
    assert [(h["steps"], h["voices"], h["span"], h["pitches"]) for h in hits] == [(2, 2, 1, [59, 63])]


def test_replacement_events():
    g = one([*ramp(0, 60, 9), (180, 660, 69)])
    events = replacement(g, lambda t: t / 960)
    assert events[:3] == [(0, 0xB0, 101, 0), (0, 0xB0, 100, 0), (0, 0xB0, 6, 12)] and events[-1] == (660, 0xE0, 0, 64)
    assert bend(0, 12) == (0, 64) and bend(12, 12) == (127, 127) and bend(-40, 12) == (1, 0)


def test_no_notes():
    assert detect(part(ramp(0, 60, 2))) == ([], [])


def test_seconds_of_many_ticks(spark):
    """The arrays' seconds are, bit by bit, those of the expression, before the first tempo event, on events, between and after them."""
    r = random.Random(3)
    for first in (0, 7):
        tempo = [(first, 500_000, first / 480 * 0.5), (300, 333_333, 0.41), (300, 410_000, 0.41), (1000, 61_237, 0.9977)]
        ticks = [*range(12), 299, 300, 301, 999, 1000, 1001, *(r.randrange(5000) for _ in range(200))]
        rows = spark.createDataFrame([(tempo, 480, ticks)], "tempo array<struct<tick:long,us:long,cum:double>>, ppq int, ticks array<long>")
        want = rows.select(F.transform("ticks", lambda x: projects.seconds(F.col("tempo"), F.col("ppq"), x)).alias("s")).first().s
        assert gestures.seconds_at(tuple(np.array(c) for c in zip(*tempo, strict=True)), 480, np.array(ticks)).tolist() == want
        one = pa.table({**{c: [[1], ticks, ticks] for c in gestures.LISTED}, "ppq": [480] * 3, "tempo": [[dict(zip(("tick", "us", "cum"), t, strict=True)) for t in x] for x in (tempo, tempo[:1], tempo)]})
        alone = [gestures.seconds_at(tuple(np.array(c) for c in zip(*tempo[:1], strict=True)), 480, np.array(ticks)).tolist(), want]
        assert [sorted(p.s0.tolist()) for p in gestures.parts_of(one.to_batches()[0].slice(1))] == [sorted(x) for x in alone]


def test_single_notes_need_no_loop(monkeypatch):
    """A part whose notes are struck apart is looked through without a list of its chords, which would be the same."""
    rows = [(i * 200, i * 200 + 180, 40 + i * 7 % 30) for i in range(60)]
    whole = part(rows)
    assert whole.alone and [c.tolist() for c in whole.chords] == [[i] for i in range(60)]
    monkeypatch.setattr(Part, "chords", property(lambda self: 1 / 0))
    again = part(rows)
    assert detect(again) == ([], []) and short_notes(again) == [] and small_figures(again, set()) == []
