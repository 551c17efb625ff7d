"""Bringing a corpus together: importing rendered audio, checking what is there, synthesising parts.

Spark works out ids, splits, gates, manifests and MIDI bytes; files are copied and written by the tasks that hold
them, to a folder that all machines see. Programs that render run on the driver, one project at a time.
"""

from __future__ import annotations

import json
import subprocess
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F

from seqloom.operators import gestures
from seqloom.plans import contract, corpus, preflight
from seqloom.plans.render import RenderError, Synthesis
from seqloom.sources import media
from seqloom.sources.projects import Projects, audio_of, gathered, stem_of

#: Fixed values of a manifest: what the contract asks of audio, and how a mixdown's level was set.
SAMPLE_RATE, NORMALIZATION = 44_100, "manual"
EXCEPTIONS = "map<string, map<string, struct<extra_pitches array<int>, reason string>>>"
MANIFEST = f"id string, split string, audio_path string, midi_path string, sample_rate_hz int, renderer string, normalization string, tail_seconds double, live_recording boolean, parts array<{contract.PART}>, approved_exceptions map<string, struct<extra_pitches array<int>, reason string>>"


def stored_splits(root: str) -> dict[str, str]:
    """Source id to split as a corpus folder holds it; empty where it holds none."""
    path = Path(root, "splits.json")
    return json.loads(path.read_text(encoding="utf-8")) if path.is_file() else {}


def store_splits(splits: dict[str, str], root: str) -> None:
    Path(root).mkdir(parents=True, exist_ok=True)
    Path(root, "splits.json").write_text(json.dumps(splits, indent=2, sort_keys=True) + "\n", encoding="utf-8")


def splits_for(spark: SparkSession, ids: DataFrame, fraction: float, root: str) -> DataFrame:
    """id, split: stored ids keep theirs, new ones are dealt among themselves; ids: (id)."""
    held = spark.createDataFrame([*stored_splits(root).items()], "id string, split string")
    return corpus.assign_splits(ids, "id", fraction, held)


def read_sidecar(path: str) -> dict:
    """A render sidecar; ValueError with all that is wrong with it."""
    try:
        text = Path(path).read_text(encoding="utf-8")
    except OSError as e:
        raise ValueError(f"no readable sidecar: {e}") from e
    if found := corpus.sidecar_problems(text):
        raise ValueError(f"{path}: {'; '.join(found)}")
    return json.loads(text)


def policies_of(spark: SparkSession, sidecar: dict) -> tuple[DataFrame, DataFrame]:
    """(aliases, policies) of a sidecar as tables for ``preflight``."""
    aliases = [(a.get("authoritative_symbolic_part"), a.get("renderer_track")) for a in sidecar.get("aliases") or [] if isinstance(a, dict)]
    policy = sidecar.get("event_policy") or {}
    rows = []
    for name, own in [(None, policy.get("default") or {}), *(policy.get("parts") or {}).items()]:
        ranges = [Row(low=int(r[0]), high=int(r[1])) if isinstance(r, list) else Row(low=int(r["low"]), high=int(r["high"])) for r in own.get("keyswitch_ranges") or own.get("ranges") or []]
        rows.append((name, own.get("action", "reject"), ranges))
    return spark.createDataFrame(aliases, "canonical_name string, renderer_track string"), spark.createDataFrame(rows, "canonical_name string, action string, ranges array<struct<low int, high int>>")


def gates(projects: Projects, allow_ramps: bool = False, allow_polyphonic: bool = False) -> DataFrame:
    """path, error: what keeps a project out, its reasons joined."""
    parts = projects.parts()
    notes = projects.timed_lists.join(parts.select("path", "track"), ["path", "track"], "left_semi")
    found = projects.files.select("path")
    count = lambda rows, c: rows.groupBy("path").agg(F.count("*").alias(c))
    found = found.join(count(gestures.glides(notes), "_g"), "path", "left").join(count(gestures.unsafe_ramps(notes), "_r"), "path", "left")
    reasons = [F.when(F.lit(not allow_ramps) & (F.col("_g") > 0), F.format_string("%d slide gesture(s) to convert first (fix-slides)", "_g")), F.when(F.lit(not allow_polyphonic) & (F.col("_r") > 0), F.format_string("%d slide ramp(s) under other notes (--allow-polyphonic-slides)", "_r"))]
    blocked = found.withColumn("error", F.concat_ws("; ", *reasons)).where("error <> ''").select("path", "error")
    return blocked.unionByName(found.join(parts.select("path").distinct(), "path", "left_anti").select("path", F.lit("no part with a canonical name").alias("error")))


def write_files(rows: DataFrame, root: str) -> None:
    """Writes (path below root, content) from the tasks that hold them, each file in one move."""

    def run(part: Iterator[Row]) -> None:
        for r in part:
            path = Path(root, r.path)
            path.parent.mkdir(parents=True, exist_ok=True)
            fresh = path.with_name(path.name + ".new")
            fresh.write_bytes(bytes(r.content))
            fresh.replace(path)

    rows.select("path", "content").foreachPartition(run)


@dataclass
class Imported:
    """Manifest rows written, errors by project, contract violations."""

    rows: DataFrame
    errors: DataFrame
    problems: DataFrame


def read_binary(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", "content")


def import_corpus(files: DataFrame, audio_files: DataFrame, out: str, sidecar: dict, renderer: str, fraction: float = 0.2, exceptions: dict | None = None, allow_ramps: bool = False, allow_polyphonic: bool = False) -> Imported:
    """Pairs projects with the audio next to them; writes MIDI, audio, provenance, manifest and splits below ``out``."""
    spark = files.sparkSession
    pairs = audio_of(files.select("path"), audio_files.select("path")).where("audio_path IS NOT NULL")
    files = files.join(pairs.select("path"), "path", "left_semi")
    projects = Projects(files)
    errors, kept, audit = preflight.preflight(projects, *policies_of(spark, sidecar))
    errors = errors.unionByName(gates(projects, allow_ramps, allow_polyphonic)).persist()
    same = Window.partitionBy("path", "program", "is_drum", "rhythm").orderBy("track")
    first = projects.parts().withColumn("_k", F.row_number().over(same)).where("_k = 1").select("path", "track")
    final = Projects(files)
    final.note_lists = gathered(kept).persist()
    final.tracks = final.tracks.join(first.unionByName(projects.unparsed().select("path", "track")), ["path", "track"], "left_semi").persist()

    splits = splits_for(spark, files.select(stem_of(F.col("path")).alias("id")), fraction, out)
    held = F.from_json(F.lit(json.dumps(exceptions or {})), EXCEPTIONS)
    rows = corpus.manifest_rows(final, media.audio_table(audio_files), splits, renderer, NORMALIZATION)
    rows = rows.join(errors.select(F.col("path").alias("source_project")), "source_project", "left_anti")
    at = lambda folder, suffix: F.concat(F.lit(f"{folder}/"), F.col("split"), F.lit("/"), F.col("id"), suffix)
    rows = rows.withColumn("source_audio", F.col("audio_path"))
    rows = rows.withColumns({
        "audio_path": at("audio", F.regexp_extract("source_audio", r"(\.[^./]*)$", 1)), "midi_path": at("midi", F.lit(".mid")), "provenance_path": at("provenance", F.lit(".json")),
        "approved_exceptions": F.coalesce(F.try_element_at(held, F.col("source_midi_id")), F.from_json(F.lit("{}"), "map<string, struct<extra_pitches array<int>, reason string>>")),
        "live_recording": F.lit(False), "sample_rate_hz": F.lit(SAMPLE_RATE), "channels": F.lit(1), **{c: F.round(c, 3) for c in ("performance_seconds", "duration_seconds", "tail_seconds")},
    }).persist()
    midi = corpus.corpus_midi(final).withColumnRenamed("path", "source_project")
    write_files(rows.join(midi, "source_project").select(F.col("midi_path").alias("path"), F.col("midi").alias("content")), out)
    write_files(rows.select("source_audio", F.col("audio_path").alias("to")).join(audio_files, F.col("source_audio") == F.col("path")).select(F.col("to").alias("path"), "content"), out)
    events = audit.groupBy(F.col("path").alias("source_project")).agg(F.collect_list(F.struct("track_name", "canonical_name", F.col("source_cc_count").alias("source_cc_events"), "source_cc_action", "keyswitch_notes", "keyswitch_action")).alias("source_event_audit"))
    base = F.lit(json.dumps({k: sidecar.get(k) for k in ("repositories", "template", "vst_profiles", "aliases")}, sort_keys=True))
    record = F.concat(F.expr("substring(to_json(struct(id AS example_id, 1 AS version, source_event_audit)), 1, length(to_json(struct(id AS example_id, 1 AS version, source_event_audit))) - 1)"), F.lit(","), F.expr("substring(base, 2)"), F.lit("\n"))
    write_files(rows.join(events, "source_project").withColumn("base", base).select(F.col("provenance_path").alias("path"), F.encode(record, "UTF-8").alias("content")), out)
    corpus.write_manifest(rows, out)
    merged = stored_splits(out) | {r.id: r.split for r in splits.toLocalIterator()}
    store_splits(merged, out)
    return Imported(rows, errors, check_corpus(spark, out))


def check_corpus(spark: SparkSession, root: str) -> DataFrame:
    """All violations of the contract by the examples of a corpus folder: id, check, message."""
    manifest = corpus.read_manifest(spark, root, MANIFEST)
    base = f"file:{Path(root).resolve()}/"
    manifest = manifest.withColumns({c: F.concat(F.lit(base), F.col(c)) for c in ("midi_path", "audio_path")})
    found = {p: read_binary(spark, root, p) for p in ("*.mid", "*.wav", "*.flac")}
    fonts = sorted(r.f for r in manifest.select(F.explode("parts.soundfont").alias("f")).distinct().where("f IS NOT NULL").collect() if Path(r.f).is_file())  # libraries, not examples
    sounds = reduce(DataFrame.unionByName, [spark.read.format("binaryFile").load(f).select(F.lit(f).alias("path"), "content") for f in fonts]) if fonts else spark.createDataFrame([], "path string, content binary")
    return contract.check(manifest, media.midi_table(found["*.mid"]), media.audio_table(found["*.wav"].unionByName(found["*.flac"])), sounds.select("path"), media.presets_table(sounds))


def part_midi(notes: list[tuple[int, int, int, int]], tempo: list[tuple[int, int]], ppq: int, channel: int, bank: int, program: int, tail_seconds: float) -> bytes:
    """A part for a synthesiser; notes: (start, end, pitch, velocity), tempo: (tick, microseconds a quarter note).

    At one tick: tempo, bank, program, note-offs, note-ons. The track ends when the tail after its last event is over.
    """
    rows = [(t, 0, b"\xff\x51\x03" + int(us).to_bytes(3)) for t, us in tempo]
    rows += [(0, 1, bytes([0xB0 | channel, 0, bank >> 7])), (0, 1, bytes([0xB0 | channel, 32, bank & 127])), (0, 2, bytes([0xC0 | channel, program]))]
    for start, end, pitch, velocity in notes:
        rows += [(start, 4, bytes([0x90 | channel, pitch, velocity])), (end, 3, bytes([0x80 | channel, pitch, 0]))]
    rows.sort(key=lambda r: r[:2])
    last = max((r[0] for r in rows), default=0)
    tail = max(1, int(tail_seconds * 1e6 / (tempo[-1][1] if tempo else 500_000) * ppq))
    return media.midi_file([media.midi_track([*((t, m) for t, _, m in rows), (last + tail, bytes([0xB0 | channel, 123, 0]))], None)], ppq)


def synthesised(projects: Projects, out: str, work: str, s: Synthesis, binary: str = "fluidsynth", run: Callable[[list[str]], None] | None = None) -> dict[str, str]:
    """path -> WAV written below ``out``, part by part through a synthesiser and mixed; one project at a time reaches the driver."""
    run = run or (lambda command: subprocess.run(command, check=True, capture_output=True) and None)
    own = projects.notes.groupBy("path", "track").agg(F.array_sort(F.collect_list(F.struct("start", "end", "pitch", "velocity"))).alias("notes"))
    parts = projects.parts().join(own, ["path", "track"], "left").groupBy("path").agg(F.array_sort(F.collect_list(F.struct("track", "soundfont", "bank", "patch", "program", "is_drum", "notes"))).alias("parts"))
    done = {}
    for r in parts.join(projects.tempo, "path").orderBy("path").toLocalIterator():
        stems = []
        for k, p in enumerate(r.parts):
            if not p.soundfont:
                raise RenderError(f"{r.project_id}: a part has no soundfont")
            folder = Path(work, r.project_id)
            folder.mkdir(parents=True, exist_ok=True)
            midi, wav = folder / f"{k}.mid", folder / f"{k}.wav"
            midi.write_bytes(part_midi([tuple(n) for n in p.notes or []], [(t.tick, t.us) for t in r.tempo], r.ppq, 9 if p.is_drum else 0, p.bank or 0, p.patch or 0, s.tail_seconds))
            try:
                run(corpus.render_arguments(binary, p.soundfont, str(midi), str(wav), s.sample_rate, s.gain))
                stems.append(media.wav_mono(wav.read_bytes())[0])
            except (subprocess.CalledProcessError, OSError) as e:
                raise RenderError(f"{r.project_id}: part {k}: {e}") from e
        path = Path(out, f"{r.project_id}.wav")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(media.wav_bytes(media.mixed(stems, s.peak_dbfs) if stems else np.zeros(1), s.sample_rate))
        done[r.path] = str(path)
    return done
