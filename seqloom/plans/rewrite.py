"""Rewriting projects: slide ramps become held chords under a bend. Spark plans the edits; the driver writes files.

A file is planned as a whole or not at all: a track of several event runs, or a gesture beyond the bend
range, refuses the file and says why. Lines that are no events stay as they are, byte for byte.
"""

from __future__ import annotations

import shutil
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seqloom.operators import gestures
from seqloom.sources.projects import Projects, paired, text_of, tracks_in

PLAN = "path string, content binary, gestures int, skipped int, notes_before int, notes_after int, error string"
_PLAN = pa.schema([("path", pa.string()), ("content", pa.binary()), *((c, pa.int32()) for c in ("gestures", "skipped", "notes_before", "notes_after")), ("error", pa.string())])


def seconds_in(tempo: list, ppq: int):
    """Ticks -> seconds over a list of (tick, us, cum)."""
    ticks, us, cum = (np.array([t[c] for t in tempo]) for c in ("tick", "us", "cum"))

    def at(tick):
        j = np.searchsorted(ticks, tick, "left") - 1
        return np.where(j >= 0, cum[j] + (tick - ticks[j]) / ppq * us[j] / 1e6, np.asarray(tick) / ppq * us[0] / 1e6)

    return at


def planned_track(lines: list[bytes], events: list[tuple], seconds, ppq: int, bend_range: int) -> tuple[dict[int, bytes], dict]:
    """New text by line number (of the track's event lines), and counts. Raises ValueError where the track is refused.

    ``events``: (run, ln, tick, status, d1, d2) in order; notes are paired across runs.
    """
    notes = sorted(paired([(0, *e[1:]) for e in events]), key=lambda n: (n[0], n[2], n[6]))
    if not notes:
        return {}, {"gestures": 0, "skipped": 0, "before": 0, "after": 0}
    columns = [np.array(c) for c in list(zip(*notes, strict=True))[:5]]
    glides, skipped = gestures.detect(gestures.Part.listed([*columns, seconds(columns[0]), seconds(columns[1])], ppq))
    counts = {"gestures": len(glides), "skipped": len(skipped), "before": len(notes), "after": len(notes)}
    if not glides:
        return {}, counts
    if len({e[0] for e in events}) > 1:
        raise ValueError("the track has several runs of events")
    if (most := max(max(abs(g["bend_from"]), abs(g["bend_to"])) for g in glides)) > bend_range:
        raise ValueError(f"a gesture needs {most} semitones of bend, the range is {bend_range}")
    gone = {i for g in glides for i in g["drop"]}
    cut = {k for i in gone for k in notes[i][5:]}
    own = [(tick, status, d1, d2, ln) for k, (_, ln, tick, status, d1, d2) in enumerate(events) if k not in cut]
    made = [(*e, -1) for g in glides for e in gestures.replacement(g, seconds, bend_range)]
    order = gestures.in_order([*own, *made])
    if max(e[0] for e in order) != max(*(e[2] for e in events), *(e[0] for e in made)):
        raise ValueError("the last tick would change")
    first = events[0][1]
    head = lines[first]
    indent, newline = head[: len(head) - len(head.lstrip())], head[len(head.rstrip(b"\r\n")) :]
    text, before = [], 0
    for tick, status, d1, d2, ln in order:
        text.append(indent + b"E %d %02x %02x %02x" % (tick - before, status, d1, d2) + newline)
        if ln >= 0 and ln + 1 < len(lines) and lines[ln + 1].strip().startswith(b"ENV"):
            text.append(lines[ln + 1])
        before = tick
    new = {}
    for ln in (e[1] for e in events):
        new[ln] = b""
        if ln + 1 < len(lines) and lines[ln + 1].strip().startswith(b"ENV"):
            new[ln + 1] = b""
    new[first] = b"".join(text)
    counts["after"] = len(notes) - len(gone) + sum(len(g["pitches"]) for g in glides)
    return new, counts


def plan(projects: Projects, bend_range: int = gestures.BEND_RANGE, only_tracks: list[str] | None = None) -> DataFrame:
    """path, new content (null: nothing to do, or refused), counts, error."""
    parts = projects.parts().select("path", "track", "track_name")
    if only_tracks:
        parts = parts.where(parts.track_name.isin(only_tracks))
    own = projects.tempo.select("path", "ppq", "tempo").join(parts.groupBy("path").agg(F.collect_set("track").alias("tracks")), "path", "left")
    files = projects.files.join(own, "path").select("path", "content", text_of(F.col("content")).alias("text"), "ppq", "tempo", "tracks")

    def planned(path: str, content: bytes, text: str, ppq: int, tempo: list, tracks: list | None, known: dict) -> dict:
        out = {"path": path, "content": None, "gestures": 0, "skipped": 0, "notes_before": 0, "notes_after": 0, "error": None}
        lines = content.splitlines(keepends=True)
        seconds, new = seconds_in(tempo, ppq), {}
        found = tracks_in(text, known)
        try:
            for k in sorted(tracks or []):
                if found[k][1]:
                    edits, n = planned_track(lines, found[k][1], seconds, ppq, bend_range)
                    new |= edits
                    for a, b in (("gestures", "gestures"), ("skipped", "skipped"), ("notes_before", "before"), ("notes_after", "after")):
                        out[a] += n[b]
            if new:
                out["content"] = b"".join(new.get(k, line) for k, line in enumerate(lines))
        except ValueError as e:
            out["error"] = str(e)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                yield pa.RecordBatch.from_pylist([planned(*(x.as_py() for x in row), known)], _PLAN)

    return files.mapInArrow(run, PLAN)


def reread(before: Projects, after: Projects) -> DataFrame:
    """path, same_others, last_tick_kept, gestures_left of rewritten files: what must hold of them before they may stay.

    Tracks without a gesture keep their notes one by one, no gesture is left, and no part ends elsewhere than it may.
    """
    note = ["start", "end", "pitch", "velocity", "channel"]
    # a row for each track, so its digest is one of its notes in order and needs no aggregation
    digest = lambda n: n.select("path", "track", F.xxhash64(F.sort_array(F.arrays_zip(*note))).alias("sum"), F.size("start").alias("n"), F.array_max("end").alias("last"))
    paths = after.files.select("path")
    held = before.note_lists.join(paths, "path", "left_semi")
    touched = gestures.glides(before.timed_lists.join(paths, "path", "left_semi")).select("path", "track").distinct().withColumn("touched", F.lit(True))
    a, b = digest(held), digest(after.note_lists).select("path", "track", *(F.col(c).alias(f"{c}_b") for c in ("sum", "n", "last")))
    both = a.join(b, ["path", "track"], "full").join(touched, ["path", "track"], "left")
    same = F.col("sum").eqNullSafe(F.col("sum_b")) & F.col("n").eqNullSafe(F.col("n_b"))
    rows = both.groupBy("path").agg(F.bool_and(F.coalesce("touched", F.lit(False)) | same).alias("same_others"), F.bool_and(F.col("last_b") >= F.col("last")).alias("last_tick_kept"))
    left = gestures.glides(after.timed_lists).groupBy("path").agg(F.count("*").alias("gestures_left"))
    return rows.join(left, "path", "left").na.fill(0, ["gestures_left"])


def verified(projects: Projects, plans: DataFrame, whole: bool = True) -> DataFrame:
    """The plans, those whose files read again aren't what they must be turned into errors; ``whole``: no gesture may be left."""
    plans = plans.persist()
    seen = reread(projects, Projects(plans.where("content IS NOT NULL AND error IS NULL").select("path", "content")))
    wrong = F.when(~F.col("same_others"), "another track would change").when(~F.col("last_tick_kept"), "a track would end earlier").when(F.lit(whole) & (F.col("gestures_left") > 0), "a gesture would be left")
    out = plans.join(seen.select("path", wrong.alias("_wrong")), "path", "left").withColumn("error", F.coalesce("error", "_wrong")).drop("_wrong")
    return out.withColumn("content", F.when(F.col("error").isNull(), F.col("content")))


def backup_of(path: Path) -> Path:
    return path.parent / "backup" / path.name


def write(plans: DataFrame, dry_run: bool = False) -> list[dict]:
    """Writes the planned files one after the other (each first copied once to its backup folder); gives the report."""
    report = []
    for r in plans.toLocalIterator():
        row = r.asDict()
        content = row.pop("content")
        path = Path(r.path.removeprefix("file:").replace("///", "/"))
        if content is not None and not r.error and not dry_run:
            kept = backup_of(path)
            if not kept.exists():
                kept.parent.mkdir(exist_ok=True)
                shutil.copy2(path, kept)
            fresh = path.with_suffix(path.suffix + ".new")
            fresh.write_bytes(bytes(content))
            if fresh.read_bytes() != bytes(content):
                fresh.unlink()
                raise OSError(f"{path}: what was written isn't what is read")
            fresh.replace(path)  # until here the project is as it was
        report.append(row | {"changed": content is not None and not r.error and not dry_run})
    return report
