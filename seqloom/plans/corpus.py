"""Building a labelled corpus: MIDI bytes, manifest rows, splits, policies, provenance, and the event rewrite."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from seqloom.functions import music
from seqloom.operators import relations
from seqloom.sources import media
from seqloom.sources.projects import Projects

DRUM_CHANNEL, REPOSITORIES = 9, 4


def corpus_midi(projects: Projects) -> DataFrame:
    """path, midi: a type-1 file of a conductor track and a named track for each part.

    Events are in order of tick with note-offs first; the byte form is put together in Python, one project at a time.
    """
    part = F.struct("track", "canonical_name", "program", "is_drum")
    notes = projects.note_lists.groupBy("path").agg(F.collect_list(F.struct("track", "start", "end", "pitch", "velocity")).alias("notes"))
    channel = lambda x, i: F.when(x["is_drum"], DRUM_CHANNEL).otherwise(music.melodic_channel(i)).cast("int")
    parts = projects.parts().groupBy("path").agg(F.sort_array(F.collect_list(part)).alias("parts")).withColumn("channels", F.transform("parts", channel))
    # the notes are never broadcast, whatever size Spark takes them for: that would leave all encoding to the few tasks of the parts
    rows = notes.hint("merge").join(parts.join(projects.tempo, "path"), "path", "right").select("path", "ppq", "time_signature", "tempo", "parts", "channels", "notes")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("path", "ppq", "time_signature", "tempo", "parts", "channels", "notes")]
            for path, ppq, signature, tempo, parts, channels, notes in zip(*columns, strict=True):
                signature = signature.as_py()
                den = max(0, int(signature["den"]).bit_length() - 1)
                conductor = [(0, bytes([0xFF, 0x58, 4, signature["num"], den, 24, 8]))]
                conductor += [(t["tick"], b"\xff\x51\x03" + t["us"].to_bytes(3)) for t in tempo.as_py()]
                body = [media.midi_track(sorted(conductor, key=lambda e: e[0]), "conductor")]
                lists = {n["track"]: n for n in notes.as_py() or []}
                for t, channel in zip(parts.as_py(), channels.as_py(), strict=True):
                    own = [] if t["is_drum"] else [(0, bytes([0xC0 | channel, t["program"]]))]
                    if n := lists.get(t["track"]):
                        pitch, velocity, on, off = n["pitch"], n["velocity"], 0x90 | channel, 0x80 | channel
                        # by tick, offs before ons, then by note
                        points = sorted([(a, 1, k) for k, a in enumerate(n["start"])] + [(b, 0, k) for k, b in enumerate(n["end"])])
                        own += [(at, bytes((on, pitch[k], velocity[k])) if rank else bytes((off, pitch[k], 0))) for at, rank, k in points]
                    body.append(media.midi_track(own, t["canonical_name"]))
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([media.midi_file(body, ppq.as_py())], pa.binary())], ["path", "midi"])

    return rows.mapInArrow(encode, "path string, midi binary")


def manifest_rows(projects: Projects, audio: DataFrame, splits: DataFrame, renderer: str, normalization: str = "none") -> DataFrame:
    """Manifest rows of projects that have audio; ids by order of path, before anything else is left out."""
    part = F.struct(
        F.col("canonical_name").alias("track_name"), "program", "is_drum", "rhythm", F.col("note_count").cast("int").alias("note_count"), "soundfont", "bank", "patch", "instrument_plugins", F.col("track_name").alias("source_track_name")
    )
    parts = projects.parts().groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("track", part.alias("p")))), lambda x: x["p"]).alias("parts"), F.max("last_tick").alias("last_tick"))
    skipped = projects.unparsed().groupBy("path").agg(F.collect_list(F.struct("name", F.lit("name is not canonical").alias("reason"))).alias("skipped_tracks"))
    from seqloom.sources.projects import audio_of, seconds

    x = relations.numbered(audio_of(projects.tempo, audio.select("path")).where("audio_path IS NOT NULL"), "path", "_n")
    a = audio.select(F.col("path").alias("audio_path"), "channels", F.col("sample_rate").alias("sample_rate_hz"), "frames", F.col("sha256").alias("source_audio_sha256"))
    x = x.join(parts, "path").join(skipped, "path", "left").join(a, "audio_path")
    performance = seconds(F.col("tempo"), F.col("ppq"), F.col("last_tick"))
    duration = F.col("frames") / F.col("sample_rate_hz")
    sha = projects.files.select("path", F.sha2("content", 256).alias("source_project_sha256"))
    return (
        x.join(splits.select(F.col("id").alias("project_id"), "split"), "project_id", "left")
        .join(sha, "path")
        .select(
            F.format_string("ex_%04d", "_n").alias("id"), F.coalesce("split", F.lit("train")).alias("split"), "audio_path", F.col("project_id").alias("source_midi_id"), F.col("path").alias("source_project"),
            "source_project_sha256", "source_audio_sha256", "sample_rate_hz", "channels", "parts", "skipped_tracks", F.lit(renderer).alias("renderer"), F.lit(normalization).alias("normalization"),
            performance.alias("performance_seconds"), duration.alias("duration_seconds"), (duration - performance).alias("tail_seconds"),
        )
    )


def write_manifest(rows: DataFrame, folder: str) -> None:
    """One JSON object a line, in parts."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/manifest.jsonl")


def read_manifest(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(f"{folder}/manifest.jsonl")


def merged_splits(existing: DataFrame, assigned: DataFrame) -> DataFrame:
    """What is stored, with the assigned ones put in; ids of neither call are lost."""
    return existing.join(assigned.select("id"), "id", "left_anti").unionByName(assigned)


def assign_splits(ids: DataFrame, column: str, fraction: float, existing: DataFrame | None = None) -> DataFrame:
    return relations.hash_split(ids, column, fraction, existing)


def sidecar_problems(text: str) -> list[str]:
    """What is wrong with a render sidecar; empty if nothing is."""
    try:
        data = json.loads(text)
    except ValueError as e:
        return [f"not JSON: {e}"]
    if not isinstance(data, dict):
        return ["not an object"]
    out = [] if data.get("schema_version") else ["schema_version missing"]
    repositories = data.get("repositories")
    if not isinstance(repositories, dict) or len([v for v in repositories.values() if isinstance(v, str) and v]) < REPOSITORIES:
        out.append("repositories: four non-empty names are needed")
    named = lambda x: isinstance(x, dict) and bool(x.get("id")) and bool(x.get("version"))
    if not named(data.get("template")):
        out.append("template: id and version are needed")
    out += [f"vst_profiles[{k}]: id and version are needed" for k, p in enumerate(data.get("vst_profiles") or []) if not named(p)]
    return out


def without_keyswitches(notes: DataFrame, policies: DataFrame) -> DataFrame:
    """Notes outside their part's key-switch ranges. policies: canonical_name (null: the default), ranges array<struct<low, high>>."""
    return relations.by_policy(notes, "canonical_name", "pitch", policies.withColumnRenamed("canonical_name", "key"))


def duplicate_parts(parts: DataFrame, notes: DataFrame) -> DataFrame:
    """Groups of parts of one label in a project: how many, whether their notes are equal, the first to keep.

    Streams are compared by a digest that adds up hashes of (note, how often), so nothing is gathered.
    """
    each = notes.groupBy("path", "track", "start", "end", "pitch", "velocity", "channel").count()
    h = F.xxhash64("start", "end", "pitch", "velocity", "channel", "count").cast("decimal(38,0)")
    digest = each.groupBy("path", "track").agg(F.sum(h).alias("_sum"), F.count("*").alias("_n"))
    x = parts.join(digest, ["path", "track"], "left")
    g = x.groupBy("path", "program", "is_drum", "rhythm").agg(F.count("*").alias("n"), F.countDistinct(F.struct(F.coalesce("_sum", F.lit(0)), F.coalesce("_n", F.lit(0)))).alias("streams"), F.min("track").alias("keep"))
    return g.where("n > 1").select("path", "program", "is_drum", "rhythm", "n", (F.col("streams") == 1).alias("equal"), "keep")


def render_arguments(binary: str, soundfont: str, midi: str, wav: str, rate: int = 44_100, gain: float = 0.6) -> list[str]:
    """Command line of a soft synthesiser for one part: no reverb, no chorus."""
    return [binary, "-ni", "-R", "0", "-C", "0", "-g", str(gain), "-r", str(rate), "-F", wav, soundfont, midi]
