"""Lint of project files: every rule's findings in one table, and a status for each project."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from seqloom.functions import music
from seqloom.operators import gestures, relations
from seqloom.sources.projects import AMPLE, AMPLE_GUITAR, BEND_RANGE, Projects

MOST_LOCATED = 40
LOCATED = ["ramp", "short", "figure"]
FINDING = ["path", "track", "rule", "severity", "tick", "message"]


def _finding(rows: DataFrame, rule: str, severity: str, message: Column, tick: Column | None = None) -> DataFrame:
    return rows.select("path", "track", F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), (F.lit(None).cast("long") if tick is None else tick.cast("long")).alias("tick"), message.alias("message"))


def part_findings(parts: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """Findings on single parts: names out of the vocabulary, mute and solo, bend ranges, missing declarations."""
    named = F.concat(F.col("canonical_name"), F.lit(" ("), F.left("track_name", F.lit(60)), F.lit(")"))
    has = lambda text: F.exists("instrument_plugins", lambda p: F.contains(p, F.lit(text)))
    bends = parts.where("bend_count > 0")
    seen = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    events = F.concat(F.lit(", "), F.col("bend_count").cast("string"), F.lit(" bend event(s)"))
    found = [
        _finding(parts.where("muted"), "muted track", "problem", F.concat(F.lit("muted track: "), named)),
        _finding(parts.where("soloed"), "soloed track", "problem", F.concat(F.lit("soloed track: "), named)),
        _finding(bends.where(has(AMPLE) & ~F.col("bend_range").eqNullSafe(F.lit(BEND_RANGE))), "bend range", "problem", F.concat(F.lit("instrument bend range is "), seen("bend_range"), F.lit(", not 12: "), named, events)),
        _finding(bends.where(has(AMPLE) & has(AMPLE_GUITAR) & ~F.coalesce("poly_bender", F.lit(False))), "poly bender", "problem", F.concat(F.lit("poly bender is off ("), seen("poly_bender"), F.lit("): "), named, events)),
        _finding(parts.where("bends_missing_rpn > 0"), "undeclared bends", "problem", F.concat(F.col("bends_missing_rpn").cast("string"), F.lit("/"), F.col("bend_count").cast("string"), F.lit(" bend event(s) missing a 12 semitone declaration: "), named)),
    ]
    if vocabulary is not None:
        slug = F.substring_index("canonical_name", ":", 1)
        unknown = parts.join(vocabulary.select(F.col(vocabulary.columns[0]).alias("_word")).distinct(), slug == F.col("_word"), "left_anti")
        found.append(_finding(unknown, "out of vocabulary", "problem", F.concat(F.lit("out-of-vocabulary instrument: "), named)))
    return reduce(DataFrame.unionByName, found)


def gesture_findings(projects: Projects, parts: DataFrame, listed: list[str]) -> DataFrame:
    """``note_findings`` of some parts."""
    own = parts.select("path", "track", "track_name", "is_drum").join(projects.tempo.select("path", "ppq", "time_signature", "tempo"), "path")  # the small tables first, so notes are dealt once
    return note_findings(projects.timed(own, ["path", "track"]), listed)


def note_findings(timed_parts: DataFrame, listed: list[str]) -> DataFrame:
    """Findings on the notes of ``Projects.timed_parts``, of the kinds ``listed`` (gestures, ramp, short, figure); those at a place begin with it, bar.beat @ m:ss.mmm."""
    found = gestures.reported(timed_parts.withColumn("_melodic", ~F.col("is_drum")), "_melodic", ("track_name", "ppq", "time_signature")).where(F.col("kind").isin(*listed))
    sig, kind = F.col("time_signature"), F.col("kind")
    where = F.concat(F.lit("bar "), music.bar_beat(F.col("start_tick"), F.col("ppq"), sig["num"], sig["den"]), F.lit(" @ "), music.clock(F.col("at_seconds")))
    name, pitches = F.left("track_name", F.lit(38)), F.concat(F.lit("["), F.array_join("pitches", ", "), F.lit("]"))
    messages = {
        "gestures": F.format_string("slide gestures needing pitch-bend conversion: %s -- %d gesture(s), %d notes -> %d, max bend %d st", F.left("track_name", F.lit(44)), "gestures", "dropped", "written", "max_bend"),
        "ramp": F.format_string("%s  slide ramp, %d notes (%s)  %s", where, "notes", "reason", name),
        "short": F.format_string("%s  short note %.0fms %s  %s", where, F.col("duration_s") * 1000, pitches, name),
        "figure": F.format_string("%s  small slide figure, %d steps %dv span %d @%.0fms from %s  %s", where, "steps", "voices", "span", F.col("step_s") * 1000, pitches, name),
    }
    of = lambda texts: F.coalesce(*(F.when(kind == k, v) for k, v in texts.items()))
    rule = of({k: F.lit(v) for k, v in (("gestures", "slide gestures"), ("ramp", "slide ramp"), ("short", "short note"), ("figure", "small slide figure"))})
    severity = of({k: F.lit(v) for k, v in (("gestures", "problem"), ("ramp", "fix"), ("short", "warn"), ("figure", "warn"))})
    return found.select("path", "track", rule.alias("rule"), severity.alias("severity"), F.col("start_tick").alias("tick"), of(messages).alias("message"))


def lint(projects: Projects, vocabulary: DataFrame | None = None, allow_ramps: bool = False, allow_polyphonic: bool = False, warnings: bool = True) -> DataFrame:
    """All findings: path, track, rule, severity (problem, fix, warn), tick, message."""
    parts = projects.parts()
    text = lambda s: F.lit(s)
    names = projects.unparsed().select("path", "track", "name")
    found = [_finding(names, "non-canonical name", "problem", F.concat(text("non-canonical track name: "), F.left("name", F.lit(70)))), part_findings(parts, vocabulary)]
    broken = projects.malformed.select("path", F.lit(None).cast("long").alias("track"), "line")
    found.append(_finding(broken, "malformed event", "problem", F.concat(text("malformed event line: "), F.left("line", F.lit(60)))))
    listed = [k for k, wanted in (("gestures", not allow_ramps), ("ramp", not allow_polyphonic), ("short", warnings), ("figure", warnings)) if wanted]
    return reduce(DataFrame.unionByName, [*found, located(projects, listed)] if listed else found).select(*FINDING)


def located(projects: Projects, listed: list[str] = LOCATED) -> DataFrame:
    """``note_findings`` of all parts; those of the kinds ``LOCATED`` are all findings of ``lint`` that have a position."""
    p = projects.timed_parts
    p = p.select(*p.columns, F.explode(F.array(gestures.lively())).alias("_lively")).where("_lively")  # not pushed below, where tempo would be worked out at each mention
    return note_findings(p, listed).select(*FINDING)


def statuses(projects: Projects, findings: DataFrame) -> DataFrame:
    """path, parts, problems, warnings, status of every project."""
    count = lambda *s: F.count(F.when(F.col("severity").isin(*s), 1))
    totals = findings.groupBy("path").agg(count("problem", "fix").alias("problems"), count("warn").alias("warnings"))
    parts = projects.parts().groupBy("path").agg(F.count("*").alias("parts"))
    out = projects.paths.join(parts, "path", "left").join(totals, "path", "left").na.fill(0, ["parts", "problems", "warnings"])
    return out.withColumn("status", relations.status(F.col("problems"), F.col("warnings")))


def worklist(findings: DataFrame, most: int = MOST_LOCATED) -> DataFrame:
    """The findings with a position, in order, the first ``most`` of each project, with how many more there are."""
    return relations.top_with_overflow(findings.where("tick IS NOT NULL"), ["path"], ["tick", "severity", "message"], most)


def exit_code(findings: DataFrame) -> int:
    """1 if anything fails; warnings don't."""
    return int(not findings.where(F.col("severity").isin("problem", "fix")).isEmpty())


def ranked_by_tick(findings: DataFrame) -> DataFrame:
    return findings.withColumn("k", F.row_number().over(Window.partitionBy("path").orderBy(F.col("tick").asc_nulls_last(), "rule", "message")))
