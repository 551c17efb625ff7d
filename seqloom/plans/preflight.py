"""What must hold before anything of a project is written: attested names, key-switch policies, attested duplicates.

All errors of all projects come as rows; the caller writes only projects without one (fail closed).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from seqloom.operators import relations
from seqloom.plans.corpus import duplicate_parts
from seqloom.sources.projects import Projects


def _error(rows: DataFrame, message: Column) -> DataFrame:
    return rows.select("path", message.alias("error"))


def preflight(projects: Projects, aliases: DataFrame, policies: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(errors, kept notes, audit).

    aliases: canonical_name, renderer_track. policies: canonical_name (null: the default), action (reject or
    remove), ranges array<struct<low int, high int>>.
    """
    parts = projects.parts()
    notes = projects.notes.join(parts.select("path", "track", "canonical_name", "track_name", "program", "is_drum", "rhythm"), ["path", "track"])
    named = parts.where("track_name <> canonical_name")
    attested = aliases.select(F.concat(F.col("canonical_name"), F.lit(" | "), F.col("renderer_track")).alias("track_name"))
    strange = named.join(attested, "track_name", "left_anti")

    kept = relations.by_policy(notes, "canonical_name", "pitch", policies.select(F.col("canonical_name").alias("key"), "ranges"))
    count = lambda x, c: x.groupBy("path", "track").agg(F.count("*").alias(c))
    audit = parts.select("path", "track", "track_name", "canonical_name", "source_cc_count").join(count(notes, "_all"), ["path", "track"], "left").join(count(kept, "_kept"), ["path", "track"], "left")
    audit = audit.withColumn("keyswitch_notes", F.coalesce("_all", F.lit(0)) - F.coalesce("_kept", F.lit(0))).drop("_all", "_kept")
    own = policies.where("canonical_name IS NOT NULL").select("canonical_name", F.col("action").alias("_own"))
    default = policies.where("canonical_name IS NULL").select("action").first()
    audit = audit.join(own, "canonical_name", "left").withColumn("action", F.coalesce("_own", F.lit(default.action if default else "reject"))).drop("_own")
    audit = audit.withColumns({"source_cc_action": F.when(F.col("source_cc_count") > 0, "dropped").otherwise("none"), "keyswitch_action": F.when(F.col("keyswitch_notes") > 0, "removed").otherwise("none")})

    twins = duplicate_parts(parts, kept.select(*projects.notes.columns))
    known = aliases.groupBy("canonical_name").agg(F.count("*").alias("attested"))
    first = parts.select("path", F.col("track").alias("keep"), "canonical_name")
    twins = twins.join(first, ["path", "keep"]).join(known, "canonical_name", "left")
    errors = [
        _error(strange, F.concat(F.lit("unattested renderer label: "), "track_name")),
        _error(audit.where("action NOT IN ('reject', 'remove')"), F.concat(F.lit("invalid key-switch action: "), "action")),
        _error(audit.where("action = 'reject' AND keyswitch_notes > 0"), F.format_string("key-switch notes in %s: %d", "track_name", "keyswitch_notes")),
        _error(twins.where("NOT equal OR coalesce(attested, 0) < n"), F.concat(F.lit("unattested duplicate part: "), "canonical_name")),
    ]
    # of attested duplicates only the first part's notes go on
    later = parts.join(twins.select("path", "program", "is_drum", "rhythm", "keep").withColumnsRenamed({"path": "_p", "program": "_g", "is_drum": "_d", "rhythm": "_r"}), (F.col("path") == F.col("_p")) & F.col("program").eqNullSafe(F.col("_g")) & (F.col("is_drum") == F.col("_d")) & F.col("rhythm").eqNullSafe(F.col("_r")) & (F.col("track") > F.col("keep"))).select("path", "track")
    return reduce(DataFrame.unionByName, errors), kept.join(later, ["path", "track"], "left_anti"), audit
