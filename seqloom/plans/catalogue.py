"""Queries over the driver's tables, one for each operator, with SQL to hold them against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from seqloom.functions import music, names
from seqloom.operators import relations as rel, sequences as seq

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    """Registers a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def days(c: str):
    return F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")).cast("long")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_fifo_pairs(spark, sf_dir)


# -- ordered rows ---------------------------------------------------------------------------------


@query("""
WITH RECURSIVE e AS (
  SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE event_type IN ('signup', 'purchase')
), r AS (
  SELECT DISTINCT user_id, 0::BIGINT AS n, []::BIGINT[] AS q, NULL::BIGINT AS on_id, NULL::BIGINT AS off_id FROM e
  UNION ALL
  SELECT e.user_id, e.n, CASE WHEN event_type = 'signup' THEN list_append(q, event_id) ELSE q[2:] END,
    CASE WHEN event_type = 'purchase' THEN q[1] END, CASE WHEN event_type = 'purchase' AND len(q) > 0 THEN event_id END
  FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1
)
SELECT user_id, on_id, greatest(off_id, on_id + 1) AS off_id FROM r WHERE on_id IS NOT NULL
""")
def q_fifo_pairs(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    pairs = seq.fifo_pairs(e, ["user_id"], ["event_id"], F.col("event_type") == "signup", F.col("event_type") == "purchase", ["event_id"])
    return pairs.select("user_id", F.col("on_event_id").alias("on_id"), F.greatest("off_event_id", F.col("on_event_id") + 1).alias("off_id"))


@query("""
WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN 1 ELSE -1 END AS d FROM events WHERE event_type IN ('signup', 'purchase')),
s AS (SELECT *, sum(d) OVER (PARTITION BY user_id ORDER BY event_id) AS s FROM e),
m AS (SELECT *, min(s) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM s)
SELECT user_id, event_id FROM m WHERE d = -1 AND s < least(0, coalesce(low, 0))
""")
def q_stray_closes(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return seq.stray_closes(e, ["user_id"], ["event_id"], F.col("event_type") == "signup", F.col("event_type") == "purchase").select("user_id", "event_id")


@query("""
WITH s AS (SELECT user_id, event_id, event_type, last_value(CASE WHEN event_type = 'signup' THEN floor(value)::BIGINT END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS declared FROM events)
SELECT user_id, event_id, declared FROM s WHERE event_type = 'error' AND declared IS DISTINCT FROM 12
""")
def q_forward_state(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    s = seq.forward_state(e, ["user_id"], ["event_id"], F.col("event_type") == "signup", F.floor("value").cast("long"), "declared")
    return s.where((F.col("event_type") == "error") & ~F.col("declared").eqNullSafe(F.lit(12))).select("user_id", "event_id", "declared")


@query("""
WITH v AS (SELECT user_id, ts, arg_max(event_id, event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY user_id, ts)
SELECT p.user_id, p.event_id, v.view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts > v.ts
""")
def q_asof_step(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("view_id", F.col("event_id"))
    out = seq.asof_before(e, ["user_id"], micros("ts"), "event_id", F.col("event_type") == "view", F.col("event_type") == "purchase", "event_id", "found")
    return out.select("user_id", "event_id", F.col("found").alias("view_id"))


@query("SELECT l_orderkey, l_linenumber, sum(l_quantity::BIGINT) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM lineitem")
def q_running_abs(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").withColumn("q", F.col("l_quantity").cast("long"))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return seq.running_total(li, ["l_orderkey"], order, "q", "upto").select("l_orderkey", "l_linenumber", "upto")


@query("SELECT user_id, event_id, event_id - coalesce(lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS delta FROM events")
def q_delta_encode(spark, sf_dir):
    return seq.deltas(read(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], ["event_id"], "event_id", "delta")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE n = 1 OR p IS DISTINCT FROM event_type")
def q_dedupe_consecutive(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return seq.dedupe_consecutive(e, ["user_id"], ["event_id"], "event_type")


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::BIGINT AS day, left(o_orderpriority, 1)::BIGINT AS rate FROM orders),
s AS (SELECT *, coalesce((day - lag(day) OVER w) * lag(rate) OVER w, 0) AS part FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY day, o_orderkey))
SELECT o_custkey, o_orderkey, sum(part) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey ROWS UNBOUNDED PRECEDING)::BIGINT AS integral FROM s
""")
def q_tempo_integral(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", days("o_orderdate").alias("day"), F.substring("o_orderpriority", 1, 1).cast("long").alias("rate"))
    return seq.step_integral(o, ["o_custkey"], ["day", "o_orderkey"], "day", "rate", "integral").select("o_custkey", "o_orderkey", "integral")


@query("""
WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts)::BIGINT AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (
  SELECT user_id, event_id, n, t AS head, 0::BIGINT AS cluster FROM e WHERE n = 1
  UNION ALL
  SELECT e.user_id, e.event_id, e.n, CASE WHEN e.t - r.head < 43200000000 THEN r.head ELSE e.t END, CASE WHEN e.t - r.head < 43200000000 THEN r.cluster ELSE r.cluster + 1 END
  FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1
)
SELECT user_id, event_id, cluster FROM r
""")
def q_greedy_cluster(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", micros("ts").alias("at"))
    return seq.greedy_clusters(e, ["user_id"], ["at", "event_id"], "at", None, 43_200_000_000, "cluster").select("user_id", "event_id", "cluster")


@query("""
WITH RECURSIVE o AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders),
e AS (SELECT o_custkey, i, CASE WHEN nx IS NULL THEN NULL WHEN nx > o_totalprice THEN 1 WHEN nx < o_totalprice THEN -1 ELSE 0 END AS label FROM (SELECT *, lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY i) AS nx FROM o)),
l AS (SELECT o_custkey, list(label ORDER BY i) AS a FROM e WHERE label IS NOT NULL GROUP BY o_custkey),
r AS (
  SELECT o_custkey, a, 0::BIGINT AS i, 0::BIGINT AS n, NULL::BIGINT AS start, 0 AS direction FROM l
  UNION ALL
  SELECT o_custkey, a, CASE WHEN k + 1 >= 4 THEN i + k + 1 ELSE i + 1 END, CASE WHEN k + 1 >= 4 THEN k + 1 ELSE 0 END, i, a[i + 1]
  FROM (SELECT o_custkey, a, i, CASE WHEN a[i + 1] = 0 THEN 0 ELSE coalesce(list_position(list_transform(a[i + 1:], lambda x: x = a[i + 1]), false) - 1, len(a) - i) END AS k FROM r WHERE i < len(a))
)
SELECT o_custkey, start, n, direction FROM r WHERE n > 0
""")
def q_monotone_chains(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    ahead = F.lead("o_totalprice").over(w)
    label = F.when(ahead > F.col("o_totalprice"), 1).when(ahead < F.col("o_totalprice"), -1).otherwise(0)
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    out = seq.monotone_chains(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], label)
    return out.select("o_custkey", F.col("start").cast("long").alias("start"), F.col("n").cast("long").alias("n"), F.col("direction").cast("int").alias("direction"))


@query("""
WITH m AS (SELECT user_id, event_id, value, event_type = 'error' AS reported FROM events WHERE value < 80),
b AS (SELECT *, reported OR coalesce(lag(reported) OVER w, true) OR NOT coalesce(abs(floor(value)::BIGINT - lag(floor(value)::BIGINT) OVER w) BETWEEN 1 AND 30 AND event_id - lag(event_id) OVER w < 2000, false) AS br
  FROM m WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
i AS (SELECT *, sum(br::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM b)
SELECT user_id, min(event_id) AS first_id, count(*) AS n FROM i WHERE NOT reported GROUP BY user_id, run HAVING count(*) >= 3
""")
def q_residual_islands(spark, sf_dir):
    e = read(spark, sf_dir, "events").where("value < 80").select("user_id", "event_id", F.floor("value").cast("long").alias("level"), "event_type")
    near = lambda before: F.abs(F.col("level") - before("level")).between(1, 30) & (F.col("event_id") - before("event_id") < 2000)
    runs = seq.residual_runs(e, ["user_id"], ["event_id"], F.col("event_type") == "error", near, 3, "run")
    return runs.groupBy("user_id", "run").agg(F.min("event_id").alias("first_id"), F.count("*").alias("n")).drop("run")


@query("""
WITH g AS (SELECT user_id, event_id, value, epoch_us(ts) - lag(epoch_us(ts)) OVER w AS gap_before, lead(epoch_us(ts)) OVER w - epoch_us(ts) AS gap_after FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, gap_before, gap_after FROM g WHERE value < 50 AND greatest(gap_before, gap_after) >= 86400000000
""")
def q_isolated(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "value", micros("ts").alias("at"))
    g = seq.gaps(e, ["user_id"], ["at", "event_id"], "at", "at").where("value < 50")
    return g.where(F.greatest("gap_before", "gap_after") >= 86_400_000_000).select("user_id", "event_id", "gap_before", "gap_after")


@query("""
WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS t, 0 AS rank FROM events WHERE event_type = 'error' UNION ALL SELECT user_id, event_id, epoch_us(ts), 1 FROM events WHERE event_type = 'click')
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY t, rank, event_id) AS place FROM e
""")
def q_event_merge_sort(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", micros("ts").alias("at"), "event_type")
    frames = [(e.where(F.col("event_type") == t), rank) for rank, t in enumerate(("error", "click"))]
    return seq.merged_order(frames, ["user_id"], "at", "event_id", "place").select("user_id", "event_id", F.col("place").cast("long").alias("place"))


@query("""
WITH o AS (SELECT o_orderkey, floor(o_totalprice / 1000)::BIGINT AS top, 100 + o_orderkey % 400 AS span FROM orders),
g AS (SELECT *, greatest(1, span // 50) AS steps FROM o), x AS (SELECT *, unnest(generate_series(1, steps)) AS i FROM g)
SELECT o_orderkey, i, (span * i // steps)::BIGINT AS at, (top * i // steps)::BIGINT AS level FROM x
""")
def q_generator(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 1000).alias("top"), (F.lit(100) + F.col("o_orderkey") % 400).alias("span"))
    zero = F.lit(0).cast("long")
    return seq.interpolated(o, zero, F.col("span"), zero, F.col("top"), F.lit(50)).select("o_orderkey", "i", "at", "level")


# -- joins by interval -----------------------------------------------------------------------------


def _spans(spark, sf_dir) -> DataFrame:
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", days("l_shipdate").alias("start"), F.col("l_quantity").cast("long").alias("length"))
    return li.select("l_orderkey", "l_linenumber", "start", (F.col("start") + F.col("length")).alias("end"), "length")


_SPANS = "s AS (SELECT l_orderkey, l_linenumber, date_diff('day', DATE '1970-01-01', l_shipdate::DATE)::BIGINT AS a, date_diff('day', DATE '1970-01-01', l_shipdate::DATE)::BIGINT + l_quantity::BIGINT AS b, l_quantity::BIGINT AS n FROM lineitem)"


@query(f"WITH {_SPANS} SELECT l_orderkey, l_linenumber FROM s l WHERE n >= 10 AND EXISTS (SELECT 1 FROM s r WHERE r.l_orderkey = l.l_orderkey AND l.a < r.a AND l.b >= r.a - 3 AND abs(l.l_linenumber - r.l_linenumber) BETWEEN 1 AND 2)")
def q_anchors_semi(spark, sf_dir):
    s = _spans(spark, sf_dir)
    near = (F.col("l.start") < F.col("r.start")) & (F.col("l.end") >= F.col("r.start") - 3) & F.abs(F.col("l.l_linenumber") - F.col("r.l_linenumber")).between(1, 2)
    return rel.exists_within(s.where("length >= 10"), s, ["l_orderkey"], near).select("l_orderkey", "l_linenumber")


@query(f"WITH {_SPANS} SELECT l.l_orderkey, l.l_linenumber, count(r.a) AS overlapping FROM s l LEFT JOIN s r ON r.l_orderkey = l.l_orderkey AND r.l_linenumber <> l.l_linenumber AND r.a < l.b AND r.b > l.a GROUP BY 1, 2")
def q_obstruct_overlap(spark, sf_dir):
    s = _spans(spark, sf_dir)
    overlap = (F.col("l.l_linenumber") != F.col("r.l_linenumber")) & (F.col("r.start") < F.col("l.end")) & (F.col("r.end") > F.col("l.start"))
    return rel.counted_within(s, s, ["l_orderkey"], ["l_orderkey", "l_linenumber"], overlap, "overlapping")


@query(f"WITH {_SPANS} SELECT l_orderkey, l_linenumber FROM s l WHERE EXISTS (SELECT 1 FROM s r WHERE r.l_orderkey = l.l_orderkey AND r.n >= 20 AND r.l_linenumber <> l.l_linenumber AND (abs(r.n - l.n) <= 5 AND abs(r.a - l.a) < 30 OR abs(r.n - l.n) <= 2 AND abs(r.b - l.b) < 60))")
def q_adjoin_exists(spark, sf_dir):
    s = _spans(spark, sf_dir)
    step, start, end = (F.abs(F.col(f"r.{c}") - F.col(f"l.{c}")) for c in ("length", "start", "end"))
    near = (F.col("l.l_linenumber") != F.col("r.l_linenumber")) & ((step <= 5) & (start < 30) | (step <= 2) & (end < 60))
    return rel.exists_within(s, s.where("length >= 20"), ["l_orderkey"], near).select("l_orderkey", "l_linenumber")


@query(f"WITH {_SPANS} SELECT l.l_orderkey, l.l_linenumber, min(r.l_linenumber) AS landing FROM s l JOIN s r ON r.l_orderkey = l.l_orderkey AND r.a > l.b AND r.n - l.n BETWEEN 1 AND 9 GROUP BY 1, 2 HAVING count(*) = 1")
def q_landing_exactly_one(spark, sf_dir):
    s = _spans(spark, sf_dir)
    r = s.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("landing"), F.col("start").alias("a"), F.col("length").alias("n"))
    hit = s.join(r, (F.col("l_orderkey") == F.col("k")) & (F.col("a") > F.col("end")) & (F.col("n") - F.col("length")).between(1, 9))
    return hit.groupBy("l_orderkey", "l_linenumber").agg(F.min("landing").alias("landing"), F.count("*").alias("c")).where("c = 1").drop("c")


# -- splits, rules, reports ---------------------------------------------------------------------------

_SPLIT = "r AS (SELECT id, row_number() OVER (ORDER BY sha256(id)) AS k, count(*) OVER () AS n FROM x)"


@query(f"WITH x AS (SELECT DISTINCT c_custkey::VARCHAR AS id FROM customer), {_SPLIT} SELECT id, CASE WHEN k <= least(greatest(1, round_even(n * 0.2, 0)), greatest(0, n - 1)) THEN 'test' ELSE 'train' END AS split FROM r")
def q_hash_split(spark, sf_dir):
    return rel.hash_split(read(spark, sf_dir, "customer"), "c_custkey", 0.2)


@query(f"""WITH f AS (SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 7 = 0 THEN 'test' ELSE 'train' END AS split FROM labels WHERE doc_id % 3 = 0),
x AS (SELECT DISTINCT doc_id::VARCHAR AS id FROM documents WHERE doc_id::VARCHAR NOT IN (SELECT id FROM f)), {_SPLIT}
SELECT id, CASE WHEN k <= least(greatest(1, round_even(n * 0.1, 0)), greatest(0, n - 1)) THEN 'test' ELSE 'train' END AS split FROM r
UNION ALL SELECT id, split FROM f WHERE id IN (SELECT doc_id::VARCHAR FROM documents)""")
def q_hash_split_frozen(spark, sf_dir):
    frozen = read(spark, sf_dir, "labels").where("doc_id % 3 = 0").select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("doc_id") % 7 == 0, "test").otherwise("train").alias("split"))
    return rel.hash_split(read(spark, sf_dir, "documents"), "doc_id", 0.1, frozen)


@query("SELECT p_partkey, trim(regexp_replace(replace(lower(p_type), '+', ' plus '), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def q_slug(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", names.slug(F.col("p_type")).alias("slug"))


_NAME_OF_PART = "CASE p_partkey % 6 WHEN 0 THEN 'drums' WHEN 1 THEN 'distortion-guitar:rhythm' WHEN 2 THEN 'acoustic-grand-piano' WHEN 3 THEN 'drums:rhythm' WHEN 4 THEN ' electric-bass-pick | take 2' ELSE lower(p_brand) END"


def _named(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", F.expr(_NAME_OF_PART).alias("name"))


@query(f"""WITH n AS (SELECT p_partkey, p_partkey % 6 AS k FROM part)
SELECT p_partkey, CASE k WHEN 1 THEN 30 WHEN 2 THEN 0 WHEN 4 THEN 34 END AS program, k = 0 AS is_drum, k = 1 AS rhythm, k IN (0, 1, 2) AS is_strict FROM n WHERE k IN (0, 1, 2, 4)""")
def q_name_parse(spark, sf_dir):
    n = _named(spark, sf_dir)
    n = n.withColumn("p", names.parsed_name(F.col("name"))).where("p IS NOT NULL")
    return n.select("p_partkey", "p.program", "p.is_drum", F.coalesce("p.rhythm", F.lit(False)).alias("rhythm"), names.parsed_name(F.col("name"), strict=True).isNotNull().alias("is_strict"))


@query(f"WITH n AS (SELECT p_partkey, p_partkey % 6 AS k FROM part) SELECT p_partkey, CASE k WHEN 0 THEN 'drums' WHEN 1 THEN 'distortion-guitar:rhythm' WHEN 2 THEN 'acoustic-grand-piano' ELSE 'electric-bass-pick' END AS name FROM n WHERE k IN (0, 1, 2, 4)")
def q_name_roundtrip(spark, sf_dir):
    n = _named(spark, sf_dir).withColumn("p", names.parsed_name(F.col("name"))).where("p IS NOT NULL")
    return n.select("p_partkey", names.part_name(F.col("p.program"), F.col("p.is_drum"), F.col("p.rhythm")).alias("name"))


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size >= 50)")
def q_dim_left_anti(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    known = p.where("p_size >= 50").select("p_brand").distinct()
    return p.join(known, "p_brand", "left_anti").select("p_partkey", "p_brand")


def _checks(spark, sf_dir) -> DataFrame:
    o, li, c = (read(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    lines = li.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.max((F.col("l_quantity") >= 10).cast("int")).alias("big"))
    joined = o.select("o_orderkey", "o_custkey", "o_totalprice").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    text = lambda c: F.col(c).cast("string")
    return rel.violations([
        ("no big line", joined.where("coalesce(big, 0) = 0"), text("o_orderkey"), F.coalesce(F.col("n"), F.lit(0)).cast("string")),
        ("total out of range", o.where("o_totalprice < 1000 OR o_totalprice > 400000"), text("o_orderkey"), F.floor("o_totalprice").cast("string")),
        ("line repeated", li.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1"), text("l_orderkey"), text("l_linenumber")),
        ("unknown customer", o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_anti"), text("o_orderkey"), text("o_custkey")),
        ("many lines", joined.where("n > 6"), text("o_orderkey"), text("n")),
    ])


_CHECKS_SQL = """x AS (SELECT l_orderkey, count(*) AS n, max((l_quantity >= 10)::INT) AS big FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey, n, big FROM orders LEFT JOIN x ON o_orderkey = l_orderkey),
v AS (SELECT 'no big line' AS rule, o_orderkey::VARCHAR AS subject, coalesce(n, 0)::VARCHAR AS detail FROM j WHERE coalesce(big, 0) = 0
UNION ALL SELECT 'total out of range', o_orderkey::VARCHAR, floor(o_totalprice)::BIGINT::VARCHAR FROM orders WHERE o_totalprice < 1000 OR o_totalprice > 400000
UNION ALL SELECT 'line repeated', l_orderkey::VARCHAR, l_linenumber::VARCHAR FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'unknown customer', o_orderkey::VARCHAR, o_custkey::VARCHAR FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'many lines', o_orderkey::VARCHAR, n::VARCHAR FROM j WHERE n > 6)"""


@query(f"WITH {_CHECKS_SQL} SELECT rule, subject, detail FROM v")
def q_contract_checks(spark, sf_dir):
    return _checks(spark, sf_dir)


@query(f"WITH {_CHECKS_SQL} SELECT rule, count(*) AS n, count(DISTINCT subject) AS subjects FROM v GROUP BY rule")
def q_contract_summary(spark, sf_dir):
    return _checks(spark, sf_dir).groupBy("rule").agg(F.count("*").alias("n"), F.countDistinct("subject").alias("subjects"))


@query("WITH s AS (SELECT conv_id, list(role ORDER BY turn) AS a FROM conversations GROUP BY conv_id) SELECT min(conv_id) AS first_key, len(a)::BIGINT AS rows, count(*) AS copies FROM s GROUP BY a")
def q_seq_duplicate_collapse(spark, sf_dir):
    return rel.sequence_duplicates(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", ["role"])


@query("SELECT sha256(text) AS digest, count(*) AS copies, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def q_exact_dups(spark, sf_dir):
    d = read(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.sha2(F.col("text"), 256).alias("digest"))
    return d.groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


_A = "SELECT l_suppkey AS supp, l_linenumber AS line FROM lineitem WHERE l_returnflag = 'A'"
_R = "SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'"


@query(f"SELECT supp, line, 'a' AS side FROM (({_A}) EXCEPT ALL ({_R})) UNION ALL SELECT l_suppkey, l_linenumber, 'b' FROM (({_R}) EXCEPT ALL ({_A}))")
def q_multiset_diff(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("supp"), F.col("l_linenumber").alias("line"), "l_returnflag")
    a, b = (li.where(F.col("l_returnflag") == f).drop("l_returnflag") for f in "AR")
    return rel.multiset_difference(a, b)


@query("SELECT p_partkey, p_brand, p_size FROM part WHERE NOT CASE WHEN p_brand = 'Brand#11' THEN p_size BETWEEN 1 AND 20 OR p_size BETWEEN 30 AND 35 WHEN p_brand = 'Brand#22' THEN false ELSE p_size BETWEEN 40 AND 50 END")
def q_policy_filter(spark, sf_dir):
    rows = [("Brand#11", [(1, 20), (30, 35)]), ("Brand#22", []), (None, [(40, 50)])]
    policies = spark.createDataFrame(rows, "key string, ranges array<struct<low: int, high: int>>")
    return rel.by_policy(read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size"), "p_brand", "p_size", policies)


@query("SELECT lang, source, arg_min(doc_id, (CASE WHEN n_chars > 2000 THEN 0 ELSE 1 END) * 1000000000000 + doc_id) AS doc_id FROM documents GROUP BY 1, 2")
def q_priority_coalesce(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("lang", "source", "doc_id", "n_chars")
    return rel.best_variant(d, ["lang", "source"], F.when(F.col("n_chars") > 2000, 0).otherwise(1), "doc_id", ["doc_id"])


@query("SELECT page_id, len(list_filter(string_split(url, '/')[:-2], lambda x: lower(x) IN ('backup', 'backups', 'www.example.com', 'example.com'))) > 0 AS inside FROM pages")
def q_path_filter(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", rel.in_backup_folder(F.col("url"), ("backup", "backups", "www.example.com", "example.com")).alias("inside"))


@query("WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, row_number() OVER w AS rank, greatest(count(*) OVER (PARTITION BY l_suppkey) - 40, 0) AS more FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber)) SELECT * FROM r WHERE rank <= 40")
def q_topn_overflow(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    out = rel.top_with_overflow(li, ["l_suppkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 40)
    return out.select("l_suppkey", "l_orderkey", "l_linenumber", F.col("rank").cast("long").alias("rank"), "more")


@query("SELECT user_id, count(*) FILTER (event_type = 'error') AS problems, count(*) FILTER (event_type = 'view') AS notes, CASE WHEN count(*) FILTER (event_type = 'error') > 15 THEN 'PROB' WHEN count(*) FILTER (event_type = 'view') > 12 THEN 'WARN' ELSE 'OK' END AS status FROM events GROUP BY user_id")
def q_status_rollup(spark, sf_dir):
    e = read(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.when(F.col("event_type") == "error", 1)).alias("problems"), F.count(F.when(F.col("event_type") == "view", 1)).alias("notes"))
    return e.withColumn("status", rel.status(F.col("problems") - 15, F.col("notes") - 12))


# -- numbers, text, nested values --------------------------------------------------------------------------


@query("WITH v AS (SELECT l_orderkey, l_linenumber, greatest(0, least(16383, round_even(8192 + greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (l_quantity - 25)::DOUBLE / 12)) * 8191, 0)::INT)) AS v FROM lineitem) SELECT l_orderkey, l_linenumber, v & 127 AS lsb, v >> 7 AS msb FROM v")
def q_bend_bytes(spark, sf_dir):
    b = music.bend_bytes(F.col("l_quantity") - 25, F.lit(12))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", b["lsb"].alias("lsb"), b["msb"].alias("msb"))


@query("WITH b AS (SELECT l_orderkey, l_linenumber, ((l_partkey * 120) / 480.0::DOUBLE) / (4.0::DOUBLE / 16) AS beats FROM lineitem) SELECT l_orderkey, l_linenumber, floor(beats / 3)::BIGINT + 1 AS bar, (beats - floor(beats / 3) * 3 + 1)::BIGINT AS beat FROM b")
def q_bar_beat(spark, sf_dir):
    tick, ppq = F.col("l_partkey") * 120, F.lit(480)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", music.bar_of(tick, ppq, F.lit(3), F.lit(16)).alias("bar"), music.beat_of(tick, ppq, F.lit(3), F.lit(16)).cast("long").alias("beat"))


@query("SELECT l_suppkey, (2 * median(l_quantity))::BIGINT AS twice_median, min(l_quantity)::BIGINT AS least, max(l_quantity)::BIGINT AS most, bool_and(l_quantity > 1) AS all_more, bool_or(l_quantity = 50) AS any_fifty FROM lineitem GROUP BY 1")
def q_medians(spark, sf_dir):
    q = F.col("l_quantity")
    return read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        (2 * F.median(q)).cast("long").alias("twice_median"), F.min(q).cast("long").alias("least"), F.max(q).cast("long").alias("most"), F.bool_and(q > 1).alias("all_more"), F.bool_or(q == 50).alias("any_fifty")
    )


@query("""WITH e AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
m AS (SELECT label, pos, sum(round_even(x::DOUBLE * 1000, 0)::BIGINT)::BIGINT AS total FROM e GROUP BY 1, 2)
SELECT label, pos::INT AS pos, total, max(abs(total)) OVER (PARTITION BY label)::BIGINT AS peak FROM m""")
def q_mix_peak(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    m = e.groupBy("label", "pos").agg(F.sum(F.rint(F.col("x").cast("double") * 1000).cast("long")).alias("total"))
    return m.withColumn("peak", F.max(F.abs("total")).over(Window.partitionBy("label")))


@query("SELECT event_id, coalesce(json_extract(props, '$.k')::INT, 0) AS k, CASE WHEN coalesce(json_extract(props, '$.k')::INT, 0) >= 50 THEN 'reject' ELSE 'remove' END AS action FROM events")
def q_json_policy(spark, sf_dir):
    k = F.coalesce(F.from_json("props", "k int")["k"], F.lit(0))
    return read(spark, sf_dir, "events").select("event_id", k.alias("k"), F.when(k >= 50, "reject").otherwise("remove").alias("action"))


@query("SELECT c_custkey, 'ex_' || CASE WHEN n < 10000 THEN lpad(n::VARCHAR, 4, '0') ELSE n::VARCHAR END AS example_id FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) AS n FROM customer) WHERE c_acctbal > 0")
def q_example_ids(spark, sf_dir):
    c = rel.numbered(read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_custkey", "n")
    return c.where("c_acctbal > 0").select("c_custkey", F.format_string("ex_%04d", F.col("n")).alias("example_id"))


@query("SELECT doc_id, coalesce(quality, -1)::INT AS quality, coalesce(toxic, 0)::INT AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def q_quality_join(spark, sf_dir):
    d, labels = read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels")
    return d.join(labels, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


from seqloom.plans import file_queries  # noqa: E402,F401  registers its queries
