"""Slide gestures in the notes of one part: detection, what is unsafe, and the events that replace them.

A slide exported note by note is a ramp of very short notes; it can be written as one held chord under a
pitch bend. Detection looks at the whole part at once (which notes sound at the same time, what a ramp
starts from and lands on), so it works on one part at a time: a row of ``Projects.timed_lists``, whose notes are
arrays. A part holds thousands of notes, not millions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Windows in seconds, lengths in quarter notes, sizes in semitones or chords.
CHORD_S, STEP_GAP_S, LEAST_CHORDS, LEAST_SPAN = 0.010, 0.12, 4, 3
FILLER_QN, FILLER_MOST_QN, HELD_S, JOIN_S = 0.10, 0.126, 0.100, 0.030
SHORT_S, SPACE_S, FIGURE_LEAST, ADJOIN_QN = 0.030, 0.080, 2, 0.10
BEND_EVERY_S, BEND_RANGE = 0.005, 12

GLIDES = "path string, track long, kind string, shape string, pitches array<int>, velocities array<int>, note_start long, note_end long, glide_start long, glide_end long, bend_from int, bend_to int, channel int, drop array<int>, at_seconds double"
RAMPS = "path string, track long, indices array<int>, reason string, at_seconds double, overlapping int, start_tick long"
SHORTS = "path string, track long, pitches array<int>, start_tick long, at_seconds double, duration_s double, gap_before_s double, gap_after_s double"
FIGURES = "path string, track long, pitches array<int>, start_tick long, at_seconds double, steps int, voices int, span int, step_s double"
LISTED = ("start", "end", "pitch", "velocity", "channel")
#: Parts whose arrays are worked on at once.
AT_ONCE = 500
NOTES = (*LISTED, "start_s", "end_s")
REPORTED = "path string, track long, kind string, gestures long, dropped long, written long, max_bend int, notes int, reason string, pitches array<int>, start_tick long, at_seconds double, duration_s double, steps int, voices int, span int, step_s double"


@dataclass
class Part:
    """Notes of a part in order of (start, pitch): ticks, seconds, pitches."""

    start: np.ndarray
    end: np.ndarray
    pitch: np.ndarray
    velocity: np.ndarray
    channel: np.ndarray
    s0: np.ndarray
    s1: np.ndarray
    ppq: int

    @classmethod
    def of(cls, notes: pd.DataFrame) -> Part:
        n = notes.sort_values(["start", "pitch", "note_ix"], kind="stable")
        return cls(*(n[c].to_numpy() for c in NOTES), int(n["ppq"].iloc[0]) if len(n) else 480)

    @classmethod
    def listed(cls, columns: list[np.ndarray], ppq: int) -> Part:
        """A part of notes in order of (start, note_ix), by the columns of ``NOTES``."""
        if len(columns[0]) and not (np.diff(columns[0]) > 0).all():
            order = np.lexsort((columns[2], columns[0]))
            columns = [c[order] for c in columns]
        return cls(*columns, ppq)

    def __post_init__(self) -> None:
        self.held = self.s1 - self.s0
        self.qn = (self.end - self.start) / self.ppq
        # single notes, the most by far, at once; chords one by one
        self.alone = bool((np.diff(self.s0) >= CHORD_S).all())
        heads = np.arange(len(self.s0)) if self.alone else np.array([c[0] for c in self.chords], int)
        d = np.diff(self.pitch[heads])
        self.moves = np.where((np.abs(d) >= 1) & (np.abs(d) <= 2), d, 0)
        if not self.alone:
            single = np.array([len(c) == 1 for c in self.chords], bool)
            for k in np.flatnonzero(~(single[:-1] & single[1:])).tolist():
                self.moves[k] = self._move(self.chords[k], self.chords[k + 1])
        self.first_s = self.s0[heads]

    @cached_property
    def chords(self) -> list[np.ndarray]:
        """Notes struck within a moment of the first and while it, or another of them, still sounds."""
        if self.alone:
            return list(np.arange(len(self.s0))[:, None])
        found: list[list[int]] = []
        until, head = -1, 0.0
        for i, (s0, start, end) in enumerate(zip(self.s0.tolist(), self.start.tolist(), self.end.tolist(), strict=True)):
            if found and s0 - head < CHORD_S and start < until:
                found[-1].append(i)
                until = max(until, end)
            else:
                found.append([i])
                until, head = end, s0
        return [np.array(g) for g in found]

    def tones(self, which) -> np.ndarray:
        return np.sort(self.pitch[which])

    def _move(self, a: np.ndarray, b: np.ndarray) -> int:
        """Semitones that every voice moves by, 1 or 2 either way; 0 if the chords don't move as one."""
        if len(a) != len(b):
            return 0
        d = self.tones(b) - self.tones(a)
        return int(d[0]) if (d == d[0]).all() and 1 <= abs(d[0]) <= 2 else 0

    def chains(self) -> list[tuple[int, int]]:
        """(first, last) chord of each maximal run in one direction, taken greedily from the left."""
        sign = np.where(np.diff(self.first_s) < STEP_GAP_S, np.sign(self.moves), 0)
        found, edge = [], 0
        if not sign.any():
            return []
        for direction, run in groupby(sign.tolist()):
            n = len(list(run))
            first = max(edge, found[-1][1] + 1 if found else 0)  # a chord belongs to one chain
            if direction and edge + n - first + 1 >= LEAST_CHORDS:
                found.append((first, edge + n))
            edge += n
        return found

    def landing(self, last: np.ndarray, after: np.ndarray | None, direction: int) -> np.ndarray | None:
        """For each voice the one held note of the next chord that goes on in the ramp's direction."""
        if after is None:
            return None
        found = []
        for p in self.tones(last):
            d = (self.pitch[after] - p) * direction
            fits = after[(d >= 1) & (d <= 2) & (self.held[after] >= HELD_S)]
            if len(fits) != 1:
                return None
            found.append(int(fits[0]))
        return np.array(found)

    def by_pitch(self, which: np.ndarray) -> tuple[list[int], list[int]]:
        order = np.asarray(which)[np.argsort(self.pitch[which], kind="stable")]
        return self.pitch[order].tolist(), self.velocity[order].tolist()


def middle(values: np.ndarray) -> float:
    """The median, as numpy has it; for the few notes of a gesture in a fraction of the time."""
    own, k = sorted(values.tolist()), len(values) // 2
    return own[k] if len(own) % 2 else (own[k - 1] + own[k]) / 2


def _ramp(part: Part, first: int, last: int) -> tuple[str, dict]:
    """What one chain is: ``("", {})`` for played notes, a glide, or a ramp that can't be converted."""
    chords = part.chords[first : last + 1]
    everything = np.concatenate(chords)
    closing = middle(part.held[chords[-1]])
    body = np.concatenate(chords[:-1])
    target: np.ndarray | None = None
    ramp, listed = chords, everything
    if len(chords) > LEAST_CHORDS and closing >= HELD_S and closing > 3 * middle(part.held[body]):
        target, ramp = chords[-1], chords[:-1]
    else:
        after = part.chords[last + 1] if last + 1 < len(part.chords) else None
        target = part.landing(chords[-1], after, int(np.sign(part.moves[first])))
        if target is not None:
            listed = np.concatenate([everything, target])
    head, tail, steps = ramp[0], ramp[-1], np.concatenate(ramp)
    begins, ends = int(part.start[head].min()), int(part.end[tail].max())
    begins_s = part.s0[head].min()

    # what the ramp departs from: notes held into its start, a tone or two from its first chord
    apart = np.abs(part.pitch[:, None] - part.pitch[head][None])
    near = ((apart == 1) | (apart == 2)).any(1)
    near[everything] = False
    sources = np.flatnonzero((part.start < begins) & (part.s1 >= begins_s - JOIN_S) & (part.held >= HELD_S) & near)
    anchored = len(sources) == len(head)
    length = middle(part.qn[steps])
    dies = anchored and abs(part.s1[sources].max() - part.s1[tail[part.end[tail].argmax()]]) < CHORD_S
    semitones = bool((np.abs(part.moves[first : first + len(ramp) - 1]) == 1).all())
    if not (dies or length < FILLER_QN or anchored and semitones and length < FILLER_MOST_QN):
        return "", {}

    into = target is not None and not anchored
    kept = sources if anchored else target if into else head
    pitches, velocities = part.by_pitch(kept)
    goal = target if target is not None and anchored else tail
    glide = {
        "kind": "slide-in" if into else "slide-out", "shape": "anchored" if anchored else "parallel" if len(head) > 1 else "bare",
        "pitches": pitches, "velocities": velocities,
        "note_start": int(part.start[sources].min()) if anchored else begins, "note_end": int(part.end[target].max()) if into else ends,
        "glide_start": begins, "glide_end": int(part.start[target].min()) if into else ends,
        "bend_from": int(part.tones(head)[0] - pitches[0]) if into else 0, "bend_to": 0 if into else int(part.tones(goal)[0] - pitches[0]),
        "channel": int(part.channel[head[0]]), "drop": sorted({*steps.tolist(), *(kept.tolist() if anchored or into else [])}),
    }
    if abs(glide["bend_to"] - glide["bend_from"]) < LEAST_SPAN:
        return "", {}
    own = {*everything.tolist(), *sources.tolist(), *glide["drop"]}
    others = [i for i in np.flatnonzero((part.start < glide["note_end"]) & (part.end > begins)).tolist() if i not in own]
    ramp_row = {"indices": listed.tolist(), "at_seconds": float(begins_s), "start_tick": begins}
    if others:
        return "ramp", ramp_row | {"reason": "polyphonic", "overlapping": len(others)}
    moved = part.tones(head if into else goal)
    if len({int(a) - b for a, b in zip(moved, pitches, strict=False)}) != 1:
        return "ramp", ramp_row | {"reason": "voices need different bends", "overlapping": len(head)}
    first_note = int(np.flatnonzero(part.start == glide["note_start"])[0])
    return "glide", glide | {"at_seconds": float(part.s0[first_note])}


def left_over(part: Part, reported: set[int]) -> list[dict]:
    """Ramps of micro notes that nothing above accounts for; a reported note ends a run, longer notes don't."""
    runs: list[list[int]] = [[]]
    for i in np.flatnonzero(part.qn < FILLER_QN).tolist():
        before = runs[-1][-1] if runs[-1] else None
        if i in reported:
            runs.append([])
            continue
        if before is not None and not (1 <= abs(int(part.pitch[i]) - int(part.pitch[before])) <= 2 and part.s0[i] - part.s0[before] < STEP_GAP_S):
            runs.append([])
        runs[-1].append(i)
    return [{"indices": r, "reason": "unconverted micro-note ramp", "at_seconds": float(part.s0[r[0]]), "overlapping": 0, "start_tick": int(part.start[r[0]])} for r in runs if len(r) >= LEAST_CHORDS]


def detect(part: Part) -> tuple[list[dict], list[dict]]:
    """Glides and unsafe ramps of a part."""
    if len(part.start) < LEAST_CHORDS:
        return [], []
    found = [_ramp(part, a, b) for a, b in part.chains()]
    glides, ramps = ([row for kind, row in found if kind == k] for k in ("glide", "ramp"))
    reported = {i for g in glides for i in g["drop"]} | {i for r in ramps for i in r["indices"]}
    return glides, sorted(ramps + left_over(part, reported), key=lambda r: r["at_seconds"])


def short_notes(part: Part) -> list[dict]:
    """Very short chords with clear space on some side."""
    if len(part.start) < 2:
        return []
    out = []
    if not (part.held < SHORT_S).any():  # then no chord is short
        return []
    opens, closes = (part.s0, part.s1) if part.alone else ([part.s0[c].min() for c in part.chords], [part.s1[c].max() for c in part.chords])
    for k, c in enumerate(part.chords):
        before = opens[k] - closes[k - 1] if k else None
        after = opens[k + 1] - closes[k] if k + 1 < len(opens) else None
        length = float(part.held[k]) if part.alone else middle(part.held[c])
        space = [g for g in (before, after) if g is not None]
        if length < SHORT_S and space and max(space) >= SPACE_S:
            out.append({"pitches": part.tones(c).tolist(), "start_tick": int(part.start[c].min()), "at_seconds": float(opens[k]), "duration_s": length, "gap_before_s": before, "gap_after_s": after})
    return out


def small_figures(part: Part, covered: set[int]) -> list[dict]:
    """Short runs of short chords, below what is converted, next to a held note."""
    if not (part.qn < FILLER_MOST_QN).any():
        return []
    runs: list[list[int]] = [[]]
    way = 0
    small = part.qn < FILLER_MOST_QN
    for k, (c, all_small) in enumerate(zip(part.chords, small.tolist() if part.alone else [small[c].all() for c in part.chords], strict=True)):
        if not all_small:
            runs.append([])
            way = 0
            continue
        if runs[-1]:
            move = int(part.moves[k - 1])
            gap = (part.start[c[0]] - part.start[part.chords[k - 1][0]]) / part.ppq
            if move and 0 < gap < FILLER_MOST_QN and way in (0, np.sign(move)):
                way = int(np.sign(move))
            else:
                runs.append([])
                way = 0
        runs[-1].append(k)
    out = []
    for r in runs:
        if not FIGURE_LEAST <= len(r) < LEAST_CHORDS:
            continue
        notes = np.concatenate([part.chords[k] for k in r])
        if covered & {*notes.tolist()}:
            continue
        a, b = notes[0], notes[-1]
        tone = lambda i: (np.abs(part.pitch - part.pitch[i]) == 1) | (np.abs(part.pitch - part.pitch[i]) == 2)
        beside = tone(a) & (np.abs(part.s1 - part.s0[a]) < JOIN_S) | tone(b) & (np.abs(part.s0 - part.s1[b]) < JOIN_S)
        if not (beside & (part.qn >= ADJOIN_QN)).any():
            continue
        first = part.chords[r[0]]
        out.append({
            "pitches": part.tones(first).tolist(), "start_tick": int(part.start[first].min()), "at_seconds": float(part.s0[first].min()), "steps": len(r), "voices": len(first),
            "span": int(abs(part.tones(part.chords[r[-1]])[0] - part.tones(first)[0])), "step_s": middle(part.held[notes]),
        })
    return out


def bend(semitones: float, bend_range: int) -> tuple[int, int]:
    """Low and high seven bits of a bend."""
    v = min(16383, max(0, round(8192 + max(-1.0, min(1.0, semitones / bend_range)) * 8191)))
    return v & 127, v >> 7


def replacement(glide: dict, seconds_of, bend_range: int = BEND_RANGE) -> list[tuple[int, int, int, int]]:
    """(tick, status, d1, d2) of the events that play a glide: range declaration, chord, bend in small steps, release, recentring."""
    c, on, off, a, b = glide["channel"], glide["note_start"], glide["note_end"], glide["glide_start"], glide["glide_end"]
    lo, hi = glide["bend_from"], glide["bend_to"]
    out = [(on, 0xB0 | c, n, v) for n, v in ((101, 0), (100, 0), (6, bend_range))]
    out.append((on, 0xE0 | c, *bend(lo, bend_range)))
    out += [(on, 0x90 | c, p, v) for p, v in zip(glide["pitches"], glide["velocities"], strict=True)]
    if a > on:
        out.append((a, 0xE0 | c, *bend(lo, bend_range)))
    n = max(1, round((seconds_of(b) - seconds_of(a)) / BEND_EVERY_S))
    out += [(round(a + (b - a) * (k / n)), 0xE0 | c, *bend(lo + (hi - lo) * (k / n), bend_range)) for k in range(1, n + 1)]
    return [*out, *((off, 0x80 | c, p, 0) for p in glide["pitches"]), (off, 0xE0 | c, 0, 64)]


def in_order(events: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """By tick; at one tick offs, controllers, bends, ons, the rest; stable."""
    rank = {0x80: 0, 0xB0: 1, 0xE0: 2, 0x90: 3}
    return sorted(events, key=lambda e: (e[0], rank.get(e[1] & 0xF0, 4)))


def seconds_at(tempo: tuple[np.ndarray, np.ndarray, np.ndarray], ppq: int, tick: np.ndarray) -> np.ndarray:
    """Seconds at ticks of a file, as ``projects.seconds`` has them; tempo: tick, us, cum in order."""
    ticks, us, cum = tempo
    at = np.searchsorted(ticks, tick) - 1
    j = np.maximum(at, 0)
    return np.where(at >= 0, cum[j] + (tick - ticks[j]) / ppq * us[j] / 1e6, tick / ppq * us[0] / 1e6)


def _lists(column: pa.Array, *fields: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """(ends, values) of a column of arrays; of structs: the values of each field."""
    ends = column.offsets.to_numpy().astype(int)
    values = column.values.slice(ends[0], ends[-1] - ends[0])
    return ends - ends[0], [v.to_numpy(zero_copy_only=False) for v in ([values.field(f) for f in fields] if fields else [values])]


def _calm(ends: np.ndarray, start: np.ndarray, end: np.ndarray, s0: np.ndarray, s1: np.ndarray, ppq: np.ndarray) -> np.ndarray:
    """Which parts have notes struck a step's gap apart at least, none of them short: nothing is a chain, a chord, micro or a figure there."""
    lively = (s1 - s0 < SHORT_S) | ((end - start) / ppq < FILLER_MOST_QN)
    near = (s0[1:] - s0[:-1] < STEP_GAP_S) | (start[1:] <= start[:-1])
    inner = np.ones(len(near), bool)
    inner[ends[(ends > 0) & (ends < len(start))] - 1] = False  # from one part to the next
    lively[1:] |= near & inner
    return np.diff(np.concatenate([[0], np.cumsum(lively)])[ends]) == 0


def lively() -> Column:
    """Whether there may be anything to find in a part (a row with ppq, tempo and ``projects.LEAST``), so that notes of others needn't be looked at.

    As ``_calm``, by the least gap and length in ticks; a part in a file with several tempos counts as lively, and so does one at the very edge.
    """
    in_seconds = lambda ticks: F.try_divide(ticks, F.col("ppq")) * F.get("tempo", F.lit(0))["us"] / 1e6
    gap, length, edge = F.coalesce("least_gap", F.lit(2**40)), F.col("least_length"), 1 + 1e-6
    short = (in_seconds(length) < SHORT_S * edge) | (F.try_divide(length, F.col("ppq")) < FILLER_MOST_QN * edge)
    return F.coalesce((F.size("tempo") != 1) | short | (gap <= 0) | (in_seconds(gap) < STEP_GAP_S * edge), F.lit(True))


def parts_of(batch: pa.RecordBatch, calm: bool = True) -> Iterator[Part | None]:
    """The parts of rows (ppq, tempo, ``LISTED``); files with one tempo, the most by far, have their seconds worked out at once.

    Without ``calm``, None for those of them in which there is nothing to find (see ``_calm``).
    """
    ends, start = _lists(batch.column(LISTED[0]))
    flat = [c.astype(int) for c in (*start, *(_lists(batch.column(c))[1][0] for c in LISTED[1:]))]
    steps, points = _lists(batch.column("tempo"), "tick", "us", "cum")
    ppq = batch.column("ppq").to_numpy()
    tick, us, cum, of = (np.repeat(v, np.diff(ends)) for v in (*(p[steps[:-1]] for p in points), ppq.astype(int)))
    flat += [np.where(t > tick, cum + (t - tick) / of * us / 1e6, t / of * us / 1e6) for t in flat[:2]]
    several = (np.diff(steps) > 1).tolist()
    skipped = np.zeros(len(several), bool) if calm else _calm(ends, flat[0], flat[1], flat[5], flat[6], of)
    for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        if skipped[i] and not several[i]:
            yield None
            continue
        own = [c[a:b] for c in flat]
        if several[i]:
            tempo = tuple(v[steps[i] : steps[i + 1]] for v in points)
            own[5:] = (seconds_at(tempo, int(ppq[i]), t) for t in own[:2])
        yield Part.listed(own, int(ppq[i]))


def per_part(timed_lists: DataFrame, schema: str, rows_of: Callable[..., list[dict]], *given: str, also: tuple[str, ...] = ()) -> DataFrame:
    """The rows that ``rows_of``, which finds gestures, ramps, short notes or figures, gives for each part (and the columns ``given`` of it), with path, track and the columns ``also`` of it."""
    out_of = StructType([*StructType.fromDDL(schema), *(timed_lists.schema[c] for c in also)])
    arrow = to_arrow_schema(out_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            out = []
            for batch in (whole.slice(at, AT_ONCE) for at in range(0, whole.num_rows, AT_ONCE)):
                rows = zip(parts_of(batch, calm=False), *(batch.column(c).to_pylist() for c in ("path", "track", *given)), strict=True)
                for i, (part, path, track, *more) in enumerate(rows):
                    if part and (own := rows_of(part, *more)):
                        same = {"path": path, "track": track, **{c: batch.column(c)[i].as_py() for c in also}}
                        out += [{**same, **r} for r in own]
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)

    return timed_lists.select(*dict.fromkeys(("path", "track", "ppq", "tempo", *given, *also, *LISTED))).mapInArrow(run, out_of)


def glides(timed_lists: DataFrame) -> DataFrame:
    return per_part(timed_lists, GLIDES, lambda p: detect(p)[0])


def unsafe_ramps(timed_lists: DataFrame) -> DataFrame:
    return per_part(timed_lists, RAMPS, lambda p: detect(p)[1])


def isolated_notes(timed_lists: DataFrame) -> DataFrame:
    return per_part(timed_lists, SHORTS, short_notes)


def covered(glides: list[dict], ramps: list[dict]) -> set[int]:
    return {i for g in glides for i in g["drop"]} | {i for r in ramps for i in r["indices"]}


def figures(timed_lists: DataFrame) -> DataFrame:
    return per_part(timed_lists, FIGURES, lambda p: small_figures(p, covered(*detect(p))))


def reported(timed_lists: DataFrame, melodic: str, also: tuple[str, ...] = ()) -> DataFrame:
    """What a report lists, each part looked at once: kind (gestures, ramp, short, figure) and its columns, others null; and the part's columns ``also``.

    Short notes and figures are those of parts for which the column ``melodic`` holds.
    """

    def rows(p: Part, melodic: bool) -> list[dict]:
        found, ramps = detect(p)
        out = []
        if found:
            most = max(max(abs(g["bend_from"]), abs(g["bend_to"])) for g in found)
            out.append({"kind": "gestures", "gestures": len(found), "dropped": sum(len(g["drop"]) for g in found), "written": sum(len(g["pitches"]) for g in found), "max_bend": most})
        out += [{"kind": "ramp", "notes": len(r["indices"]), **{c: r[c] for c in ("reason", "start_tick", "at_seconds")}} for r in ramps]
        if melodic:
            out += [{"kind": "short", **{c: r[c] for c in ("pitches", "start_tick", "at_seconds", "duration_s")}} for r in short_notes(p)]
            out += [{"kind": "figure", **r} for r in small_figures(p, covered(found, ramps))]
        return out

    return per_part(timed_lists, REPORTED, rows, melodic, also=also)


def gesture_totals(found: DataFrame) -> DataFrame:
    """path, track, gestures, notes dropped, notes written, largest bend."""
    return found.groupBy("path", "track").agg(
        F.count("*").alias("gestures"), F.sum(F.size("drop")).alias("dropped"), F.sum(F.size("pitches")).alias("written"), F.max(F.greatest(F.abs("bend_from"), F.abs("bend_to"))).alias("max_bend")
    )
