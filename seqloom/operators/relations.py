"""Operators over whole tables: joins by interval, splits, rule reports, duplicates, policies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def exists_within(left: DataFrame, right: DataFrame, by: list[str], condition: Column) -> DataFrame:
    """Rows of ``left`` (aliased l) with some row of ``right`` (aliased r) of the same key that meets the condition."""
    keys = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in by]
    return left.alias("l").join(right.alias("r"), reduce(lambda a, b: a & b, keys) & condition, "left_semi")


def counted_within(left: DataFrame, right: DataFrame, by: list[str], ids: list[str], condition: Column, name: str) -> DataFrame:
    """``ids`` of left with the number of rows of right of the same key that meet the condition (0 if none).

    Both sides are dealt by ``by``; the count is by ids, which hold ``by``, so it needs no exchange of its own.
    """
    keys = reduce(lambda a, b: a & b, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in by])
    joined = left.alias("l").join(right.withColumn("_hit", F.lit(1)).alias("r"), keys & condition, "left")
    return joined.groupBy(*(F.col(f"l.{c}").alias(c) for c in ids)).agg(F.count("r._hit").alias(name))


def hash_split(ids: DataFrame, id_column: str, fraction: float, frozen: DataFrame | None = None) -> DataFrame:
    """(id, split): distinct new ids in order of their SHA-256; the first rint(n * fraction) are test, at least 1, at most n - 1.

    Frozen ids (id, split) keep theirs. The cut is found without a global sort: counts by hash prefix (a
    table of at most 65,536 rows) tell the prefix that the cut falls in, and only ids of that prefix are ranked.
    """
    every = ids.select(F.col(id_column).cast("string").alias("id")).where("id IS NOT NULL").distinct()
    new = every.join(frozen.select("id"), "id", "left_anti") if frozen is not None else every
    hashed = new.withColumn("h", F.sha2("id", 256)).withColumn("p", F.substring("h", 1, 4))
    counts = {r["p"]: r["count"] for r in hashed.groupBy("p").count().collect()}
    n = sum(counts.values())
    most = 0 if fraction <= 0 or not n else min(max(1, round(n * fraction)), max(0, n - 1))
    before, edge = 0, ""
    for p in sorted(counts):
        edge = p
        if before + counts[p] >= most:
            break
        before += counts[p]
    rank = F.row_number().over(Window.partitionBy("p").orderBy("h"))
    low = hashed.where(F.col("p") < edge).select("id", F.lit("test").alias("split"))
    high = hashed.where(F.col("p") > edge).select("id", F.lit("train").alias("split"))
    mid = hashed.where(F.col("p") == edge).select("id", F.when(rank <= most - before, "test").otherwise("train").alias("split"))
    if not most:
        out = hashed.select("id", F.lit("train").alias("split"))
    else:
        out = low.unionByName(mid).unionByName(high)
    return out.unionByName(frozen.join(every, "id", "left_semi").select("id", "split")) if frozen is not None else out


def violations(checks: list[tuple[str, DataFrame, Column, Column]]) -> DataFrame:
    """One table (rule, subject, detail) of the findings of all rules: (rule, rows at fault, subject, detail)."""
    parts = [rows.select(F.lit(rule).alias("rule"), subject.cast("string").alias("subject"), detail.cast("string").alias("detail")) for rule, rows, subject, detail in checks]
    return reduce(DataFrame.unionByName, parts)


def top_with_overflow(rows: DataFrame, by: list[str], order: list, most: int) -> DataFrame:
    """The first ``most`` rows of each key with their rank, and how many more there were."""
    w = Window.partitionBy(*by)
    ranked = rows.withColumn("rank", F.row_number().over(w.orderBy(*order)))
    return ranked.withColumn("more", F.greatest(F.count("*").over(w) - most, F.lit(0))).where(F.col("rank") <= most)


def sequence_duplicates(rows: DataFrame, by: str, order: str, content: list[str]) -> DataFrame:
    """Keys whose ordered rows are equal: digest, n, first key. The digest adds position-bound row hashes, so no list is gathered."""
    at = F.row_number().over(Window.partitionBy(by).orderBy(order))
    h = rows.withColumn("_h", F.sha2(F.to_json(F.struct(at.alias("k"), *(F.col(c) for c in content))), 256))
    parts = [F.sum(F.conv(F.substring("_h", i, 12), 16, 10).cast("decimal(20,0)")).alias(f"_p{i}") for i in (1, 13, 25)]
    keys = h.groupBy(by).agg(F.count("*").alias("rows"), *parts)
    return keys.groupBy("rows", "_p1", "_p13", "_p25").agg(F.count("*").alias("copies"), F.min(by).alias("first_key")).select("first_key", "rows", "copies")


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a that b lacks and of b that a lacks, by count; ``side`` tells which."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def by_policy(rows: DataFrame, key: str, value: str, policies: DataFrame) -> DataFrame:
    """Drops rows whose value falls in a range of their key's policy, or of the default (null key) where it has none.

    policies: key, ranges array<struct<low, high>>; one row per key, broadcast only if Spark finds it small.
    """
    default = policies.where(F.col("key").isNull()).select(F.col("ranges").alias("_default"))
    named = policies.where(F.col("key").isNotNull()).select(F.col("key").alias("_key"), F.col("ranges").alias("_own"))
    row = default.first()
    ranges = F.coalesce("_own", F.array(*(F.struct(F.lit(r["low"]).alias("low"), F.lit(r["high"]).alias("high")) for r in row["_default"])) if row and row["_default"] else F.array().cast(named.schema["_own"].dataType))
    hit = F.exists(ranges, lambda r: F.col(value).between(r["low"], r["high"]))
    return rows.join(named, F.col(key) == F.col("_key"), "left").where(~hit).drop("_key", "_own")


def best_variant(rows: DataFrame, by: list[str], priority: Column, tie: str, carry: list[str]) -> DataFrame:
    """One row per key: the carried columns of the row with the least (priority, tie)."""
    best = F.min_by(F.struct(*carry), F.struct(priority.alias("p"), F.col(tie).alias("t"))).alias("_best")
    return rows.groupBy(*by).agg(best).select(*by, *(F.col(f"_best.{c}").alias(c) for c in carry))


def status(problems: Column, notes: Column) -> Column:
    """PROB over WARN over OK."""
    return F.when(problems > 0, "PROB").when(notes > 0, "WARN").otherwise("OK")


def in_backup_folder(path: Column, names: tuple[str, ...] = ("backup", "backups")) -> Column:
    """Is some folder of the path (not its last component) a backup folder, in any case?"""
    parts = F.split(path, "/")
    return F.exists(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: F.lower(x).isin(*names))


def numbered(rows: DataFrame, key: str, name: str, buckets: int = 256) -> DataFrame:
    """Dense numbers from 1 in order of a key, without a task that holds all rows.

    Some keys (a bounded number, chosen by hash) part the order into buckets; a bucket's numbers begin after the
    counts of those before it. Any choice of keys gives the same numbers. Null keys come first.
    """
    cuts = sorted(r[0] for r in rows.where(F.col(key).isNotNull()).select(key).distinct().orderBy(F.xxhash64(key), key).limit(buckets).collect())
    bounds = F.array(*(F.lit(c) for c in cuts)) if cuts else F.array().cast(f"array<{dict(rows.dtypes)[key]}>")
    placed = rows.withColumn("_bucket", F.coalesce(F.size(F.filter(bounds, lambda c: c <= F.col(key))), F.lit(0)))
    counts = placed.groupBy("_bucket").count().collect()  # at most one row a bucket
    before = {r["_bucket"]: sum(o["count"] for o in counts if o["_bucket"] < r["_bucket"]) for r in counts}
    offset = F.lit(0).cast("long")
    if before:
        offset = F.element_at(F.create_map(*(F.lit(x) for pair in before.items() for x in pair)), F.col("_bucket")).cast("long")
    own = F.row_number().over(Window.partitionBy("_bucket").orderBy(F.col(key).asc_nulls_first()))
    return placed.withColumn(name, offset + own).drop("_bucket")
