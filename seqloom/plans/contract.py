"""The corpus contract: numbered checks over a manifest and its files, as one table of violations.

``manifest``: id, midi_path, audio_path, sample_rate_hz, renderer, normalization, tail_seconds, live_recording,
parts array<struct<track_name, program, is_drum, rhythm, note_count, soundfont, bank, patch, instrument_plugins>>,
approved_exceptions map<string, struct<extra_pitches array<int>, reason string>>.
``midi``: media.midi_table, ``audio``: media.audio_table, ``presets``: media.presets_table, ``files``: path of all files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from seqloom.functions import names

#: Fixed values of the contract.
PITCHES, DRUM_PITCHES, TAIL_S = (21, 108), (27, 87), (-0.5, 30.0)
PART = "struct<track_name string, program int, is_drum boolean, rhythm boolean, note_count int, soundfont string, bank int, patch int, instrument_plugins array<string>>"


def _found(rows: DataFrame, check: int, message: Column) -> DataFrame:
    return rows.select("id", F.lit(check).alias("check"), message.alias("message"))


def manifest_checks(manifest: DataFrame) -> DataFrame:
    """Checks that the manifest alone decides: 1, 2, 4, 11, 12, and the part of 10 without files."""
    guitar = F.exists("parts", lambda p: ~p["is_drum"] & names.is_guitar(p["program"]))
    labels = F.transform("parts", lambda p: F.struct(p["program"], p["is_drum"], p["rhythm"]))
    parts = manifest.select("id", "live_recording", F.explode("parts").alias("p"))
    canonical = names.part_name(F.col("p.program"), F.col("p.is_drum"), F.col("p.rhythm"))
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    tail = F.col("tail_seconds")
    undriven = F.col("p.soundfont").isNull() & (F.coalesce(F.size("p.instrument_plugins"), F.lit(0)) <= 0) & ~F.coalesce("live_recording", F.lit(False))
    found = [
        _found(manifest.where(~F.coalesce(guitar, F.lit(False))), 1, F.lit("no guitar part")),
        _found(parts.where(~F.col("p.track_name").eqNullSafe(canonical)), 2, F.concat(F.col("p.track_name"), F.lit(" is not canonical ("), canonical, F.lit(")"))),
        _found(manifest.where(F.size(labels) != F.size(F.array_distinct(labels))), 4, F.lit("two parts share a program and rhythm")),
        _found(parts.where(undriven), 10, F.concat(F.col("p.track_name"), F.lit(" has neither a soundfont nor an instrument chain"))),
        _found(manifest.where(empty("renderer") | empty("normalization")), 11, F.lit("renderer or normalization missing")),
        _found(manifest.where(tail < TAIL_S[0]), 12, F.format_string("audio ends %.2fs before the last note-off: truncated", -tail)),
        _found(manifest.where(tail > TAIL_S[1]), 12, F.format_string("audio runs %.2fs past the last note-off: misalignment", tail)),
    ]
    return reduce(DataFrame.unionByName, found)


def soundfont_checks(manifest: DataFrame, files: DataFrame, presets: DataFrame) -> DataFrame:
    """Check 10: soundfonts exist, are readable, and have the part's preset."""
    parts = manifest.select("id", F.explode("parts").alias("p")).select("id", "p.*").where("soundfont IS NOT NULL")
    missing = parts.join(files.select(F.col("path").alias("soundfont")), "soundfont", "left_anti")
    there = parts.join(files.select(F.col("path").alias("soundfont")), "soundfont", "left_semi")
    fonts = presets.select(F.col("path").alias("soundfont"), "bank", "patch")
    unreadable = there.join(fonts, "soundfont", "left_anti")
    lacking = there.join(fonts, "soundfont", "left_semi").join(fonts, ["soundfont", "bank", "patch"], "left_anti")
    return (
        _found(missing, 10, F.concat(F.lit("missing soundfont "), "soundfont"))
        .unionByName(_found(unreadable, 10, F.concat(F.lit("unreadable soundfont "), "soundfont")))
        .unionByName(_found(lacking, 10, F.format_string("%s lacks bank %d patch %d", "soundfont", "bank", "patch")))
    )


def audio_checks(manifest: DataFrame, audio: DataFrame) -> DataFrame:
    """Check 6: audio exists, is mono, of the manifest's rate, 16 bits, not silent."""
    x = manifest.select("id", "sample_rate_hz", F.col("audio_path").alias("path")).join(audio.withColumn("_there", F.lit(True)), "path", "left")
    there = x.where("_there")
    found = [
        _found(x.where("_there IS NULL"), 6, F.lit("audio missing")),
        _found(there.where("NOT channels <=> 1"), 6, F.format_string("audio has %d channels, expected mono", "channels")),
        _found(there.where("NOT sample_rate <=> sample_rate_hz"), 6, F.format_string("audio is %d Hz, expected %d", "sample_rate", "sample_rate_hz")),
        _found(there.where("NOT bits <=> 16"), 6, F.lit("audio is not 16-bit PCM")),
        _found(there.where("coalesce(silent, false) OR coalesce(frames, 0) = 0"), 6, F.lit("audio is silent")),
    ]
    return reduce(DataFrame.unionByName, found)


def midi_checks(manifest: DataFrame, midi: DataFrame) -> DataFrame:
    """Checks 3, 5, 7, 8: programs, tracks and note counts against the manifest, pitch ranges."""
    files = manifest.select("id", "approved_exceptions", F.col("midi_path").alias("path"))
    name = F.min_by(F.decode("payload", "ISO-8859-1"), F.when((F.col("status") == 255) & (F.col("d1") == 3), F.col("tick")))
    kind = F.col("status").bitwiseAND(0xF0)
    voice = F.col("status") < 0xF0
    on = voice & (kind == 0x90) & (F.col("d2") > 0)
    change, bank = voice & (kind == 0xC0), voice & (kind == 0xB0) & F.col("d1").isin(0, 32)
    # messages are summed up by track before anything is joined; a pitch that every range holds can't be at fault
    tracks = midi.groupBy("path", "track").agg(name.alias("track_name"), F.count(F.when(change, 1)).alias("changes"), F.min(F.when(change, F.col("d1"))).alias("carried"), F.count(F.when(bank, 1)).alias("banks"), F.count(F.when(on, 1)).alias("notes"))
    both = max(PITCHES[0], DRUM_PITCHES[0]), min(PITCHES[1], DRUM_PITCHES[1])
    pitches = midi.where(on & ~F.col("d1").between(*both)).groupBy("path", "track", F.col("d1").alias("pitch")).agg(F.count("*").alias("n"))
    there = tracks.select("path").distinct()
    missing = files.join(there, "path", "left_anti")
    t = tracks.join(files.select("id", "path"), "path").where("coalesce(track_name, '') NOT IN ('', 'conductor')")
    parts = manifest.join(files.join(there, "path", "left_semi").select("id").distinct(), "id", "left_semi").select("id", F.explode("parts").alias("p")).select("id", "p.track_name", "p.program", "p.is_drum", "p.note_count")
    known = t.join(parts, ["id", "track_name"])
    melodic = known.where("NOT is_drum")
    pitch = pitches.join(files, "path").join(known.select("id", "path", "track", "track_name", "is_drum"), ["id", "path", "track"])
    low, high = F.when(F.col("is_drum"), DRUM_PITCHES[0]).otherwise(PITCHES[0]), F.when(F.col("is_drum"), DRUM_PITCHES[1]).otherwise(PITCHES[1])
    allowed = F.coalesce(F.array_contains(F.try_element_at("approved_exceptions", F.col("track_name"))["extra_pitches"], F.col("pitch")), F.lit(False))
    odd = pitch.where(~F.col("pitch").between(low, high) & ~allowed).groupBy("id", "track_name", low.alias("low"), high.alias("high")).agg(F.sum("n").alias("n"))
    counted = parts.join(t.select("id", "track_name", "notes"), ["id", "track_name"], "left").where("NOT notes <=> note_count")
    found = [
        _found(missing, 7, F.lit("MIDI missing")),
        _found(t.join(parts, ["id", "track_name"], "left_anti"), 5, F.format_string("MIDI track %s is not in the manifest", "track_name")),
        _found(melodic.where("changes <> 1"), 3, F.format_string("%s has %d program changes", "track_name", "changes")),
        _found(melodic.where("changes = 1 AND carried <> program"), 3, F.format_string("%s carries program %d, labelled %d", "track_name", "carried", "program")),
        _found(known.where("banks > 0"), 3, F.format_string("%s contains a bank-select event", "track_name")),
        _found(odd, 8, F.format_string("%s has %d notes outside %d-%d", "track_name", "n", "low", "high")),
        _found(counted, 5, F.concat(F.col("track_name"), F.lit(" has "), F.coalesce(F.col("notes").cast("string"), F.lit("no")), F.lit(" notes in MIDI, manifest says "), F.coalesce(F.col("note_count").cast("string"), F.lit("none")))),
    ]
    return reduce(DataFrame.unionByName, found)


def check(manifest: DataFrame, midi: DataFrame, audio: DataFrame, files: DataFrame, presets: DataFrame) -> DataFrame:
    """All violations: id, check, message."""
    parts = [manifest_checks(manifest), soundfont_checks(manifest, files, presets), audio_checks(manifest, audio), midi_checks(manifest, midi)]
    return reduce(DataFrame.unionByName, parts)
