"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document is held against rules; failures are added up by host (``source``), and a host's
failure rate is shrunk to the corpus by a beta prior fitted to all hosts (beta-binomial moments: hosts weigh
by their size, and what chance alone makes rates of small hosts vary is taken off): a host of
two documents with one failure says little, one of a million a lot. A host whose shrunk rate reaches
``HOST_LIMIT`` is rejected as a whole, and the verdict goes back to its documents.

Words are what white space (space, U+0009 to U+000D) separates. Repeated five-word windows are
found by a 64-bit hash of the window within the one document.

Defined cases: null or empty text: no words, fails (fewer than 10 words); null hosts form one
host; repeated rows count each and are each judged; an empty table gives an empty result; a host on the limit is rejected; extra columns
are ignored, or kept by ``keep``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import common
from .common import cut, written

LEAST_WORDS, REPEATED_PERCENT, WINDOW = 10, 20, 5
#: More than so many symbols for 100 words, or repeated lines for 100 lines with a word, fail.
SYMBOLS_PERCENT, DUP_LINES_PERCENT = 50, 30
HOST_LIMIT = 0.5
#: Rejected hosts that are broadcast at most; with more, documents are dealt by host and salt.
MOST_BROADCAST, SALTS = 100_000, 32
#: Bounds of the prior's weight in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 10_000.0

_BLANKS = " \t\n\x0b\f\r"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def with_measures(docs: DataFrame, text: Column) -> DataFrame:
    """The rows as one struct column ``_row``, so that no name can clash, and their ``_measures``.

    Several projections, so that nothing is worked out per word twice.
    """
    kept = [F.col("_row")]
    d = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.coalesce(text, F.lit("")).alias("_text"))
    d = d.select(*kept, "_text", F.array_remove(F.split(F.btrim("_text", F.lit(_BLANKS)), r"[ \x09-\x0D]+"), "").alias("_words"))
    windows = F.when(F.size("_words") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    d = d.select(
        *kept,
        F.size("_words").cast("long").alias("_n"),
        F.length(F.array_join("_words", "")).cast("long").alias("_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("_symbols"),
        lines.alias("_lines"),
        windows.alias("_windows"),
    )
    # places of the windows found twice or more; only worked out where there are any
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    d = d.select(*kept, "_n", "_chars", "_symbols", "_lines", F.when(again, F.array_sort(F.transform("_windows", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))).alias("_sorted"))

    def place(k: Column) -> Column:
        own = F.element_at("_sorted", k)
        twin = (k > 1) & (F.get("_sorted", k - 2)["g"] == own["g"]) | (k < F.size("_sorted")) & (F.get("_sorted", k)["g"] == own["g"])
        return F.when(twin, own["i"])

    d = d.select(*kept, "_n", "_chars", "_symbols", "_lines", F.when(F.col("_sorted").isNotNull(), F.array_sort(F.array_compact(F.transform(F.sequence(F.lit(1), F.size("_sorted")), place)))).alias("_places"))
    covered = F.aggregate(
        "_places", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"],
    )
    measures = {
        "n_words": F.col("_n"), "word_chars": F.col("_chars"), "n_symbols": F.col("_symbols"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")), "n_lines": F.size("_lines").cast("long"),
    }
    return d.select(*kept, F.struct(*(v.alias(k) for k, v in measures.items())).alias("_measures"))


def base_failed(m: str = "_measures") -> Column:
    n, r = F.col(f"{m}.n_words"), F.col(f"{m}.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * r > REPEATED_PERCENT * n)


def rule_failed(m: str = "_measures") -> Column:
    """Any rule: the base ones, symbols, repeated lines."""
    get = lambda c: F.col(f"{m}.{c}")
    return base_failed(m) | (100 * get("n_symbols") > SYMBOLS_PERCENT * get("n_words")) | (100 * get("n_dup_lines") > DUP_LINES_PERCENT * get("n_lines"))


def prior(hosts: int, failures: int, n: int, squares: float, scatter: float) -> tuple[float, float]:
    """Mean and weight of the beta prior; squares: sum of n * n, scatter: sum of f * f / n over the hosts.

    The scatter of host rates, weighted by size, is on average ``mean * (1 - mean)`` times ``hosts - 1`` for chance
    and ``overlap * (n - squares / n - (hosts - 1))`` for true differences; the weight is 1 / overlap - 1.
    """
    mean = failures / n if n else 0.0
    room = n - squares / n - (hosts - 1) if n else 0.0
    if not 0 < mean < 1 or room <= 1e-9:
        return mean, MOST_WEIGHT
    overlap = ((scatter - mean * failures) / (mean * (1 - mean)) - (hosts - 1)) / room
    return mean, MOST_WEIGHT if overlap <= 0 else min(MOST_WEIGHT, max(LEAST_WEIGHT, 1 / overlap - 1))


def host_verdicts(failures: DataFrame) -> DataFrame:
    """(host, failed) rows -> host, n, failures, rate (shrunk), rejected."""
    hosts = cut(failures.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("failures")))
    n = F.col("n").cast("double")
    s = hosts.agg(F.count("*").alias("k"), F.sum("failures").alias("f"), F.sum("n").alias("n"), F.sum(n * n).alias("nn"), F.sum(F.col("failures") * F.col("failures") / n).alias("ff")).first()
    mean, weight = prior(s.k, s.f or 0, s.n or 0, s.nn or 0.0, s.ff or 0.0)
    shrunk = (F.col("failures") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return hosts.withColumn("rate", shrunk).withColumn("rejected", F.col("rate") >= HOST_LIMIT)


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: measures, base_failed, its host's shrunk rate, kept."""
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).alias("text"))
    rows = cut(with_measures(plain, F.col("text")).select("_row.doc_id", "_row.host", *(f"_measures.{c}" for c in MEASURES), base_failed().alias("base_failed"), rule_failed().alias("failed")))
    hosts = host_verdicts(rows.select("host", "failed"))
    verdicts = hosts.select(F.col("host").alias("h"), F.col("rate").alias("host_rate"), "rejected")
    joined = rows.join(verdicts, F.col("host").eqNullSafe(F.col("h")))
    return joined.select("doc_id", *MEASURES[:-1], "base_failed", (~F.col("base_failed") & ~F.col("rejected")).alias("kept"), "host_rate")


def keep(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that are kept, all columns as they were, whatever their names; an empty table stays empty.

    Each text is measured once: rows and flags are written to the shared folder, and hosts are judged from the flags.
    """
    own = F.col("_row").getField(host).cast("string")
    marked = written(with_measures(docs, F.col(f"`{text}`")).select("_row", own.alias("_host"), base_failed().alias("_base"), rule_failed().alias("_failed")))
    hosts = host_verdicts(marked.select(F.col("_host").alias("host"), F.col("_failed").alias("failed")))
    rejected = hosts.where("rejected").select(F.col("host").alias("_bad"))
    marked, same = marked.where("NOT _base"), F.col("_host").eqNullSafe(F.col("_bad"))
    if rejected.count() <= MOST_BROADCAST:
        kept = marked.join(F.broadcast(rejected), same, "left_anti")
    else:  # the rows of one host go to several tasks
        marked = marked.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)))
        rejected = rejected.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        kept = marked.join(rejected, same & (F.col("_salt") == F.col("_other")), "left_anti")
    return kept.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "documents")).drop("host_rate")


_MEASURES_SQL = rf"""
t AS (SELECT doc_id, source, coalesce(text, '') AS t FROM {{docs}}),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS a, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (SELECT doc_id, i, array_to_string(a[i:i+4], ' ') AS g FROM (SELECT doc_id, a, unnest(range(1, len(a) - 3)) AS i FROM w))),
p AS (SELECT doc_id, sum(least(5, i - prev)) AS n FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -5) AS prev FROM g WHERE c > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, w.source, len(a)::BIGINT AS n_words, length(array_to_string(a, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
  coalesce(p.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN p USING (doc_id)),
f AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words AS base_failed FROM m),
r AS (SELECT *, base_failed OR 100 * n_symbols > {SYMBOLS_PERCENT} * n_words OR 100 * n_dup_lines > {DUP_LINES_PERCENT} * n_lines AS failed FROM f),
h AS (SELECT source, count(*) AS n, sum(failed::INT) AS fails FROM r GROUP BY source),
s AS (SELECT count(*) AS k, sum(fails)::DOUBLE AS f, sum(n)::DOUBLE AS n, sum(n::DOUBLE * n) AS nn, sum(fails::DOUBLE * fails / n) AS ff FROM h),
o AS (SELECT f / n AS mean, CASE WHEN f = 0 OR f = n OR n - nn / n - (k - 1) <= 1e-9 THEN 0 ELSE ((ff - f / n * f) / (f / n * (1 - f / n)) - (k - 1)) / (n - nn / n - (k - 1)) END AS overlap FROM s),
k AS (SELECT mean, CASE WHEN overlap <= 0 THEN {MOST_WEIGHT} ELSE least({MOST_WEIGHT}, greatest({LEAST_WEIGHT}, 1 / overlap - 1)) END AS weight FROM o),
b AS (SELECT source, (fails + mean * weight) / (n + weight) >= {HOST_LIMIT} AS rejected FROM h, k)
"""
ORACLE_SQL = "WITH " + _MEASURES_SQL.format(docs="documents") + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source"
