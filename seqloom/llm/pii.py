"""Personal data by weak supervision, in DataFrame functions only.

Four base kinds are found by pattern and checked (address parts, Luhn digits, digit counts). On top,
candidates of weaker patterns are judged by labelers that vote for, against or not at all: a pattern
labeler (checksum or strict shape), a gazetteer labeler (known prefixes and endings), and two
context labelers (telling words before the span, words that speak against it). Expectation-
maximisation over the counts of vote patterns gives each labeler's reliability and each pattern's
probability; a logistic span classifier is trained on those probabilities over span features.
Candidates that it accepts, and that overlap no base span, are added; base spans stay.

Both models are fitted from counts over all candidates of the corpus; votes and features take
few values, so the tables of counts that reach the driver have a fixed size bound, whatever the input.

Patterns are anchored or possessive where that leaves the matches as they are, so that long runs
take linear time and no deep recursion.

Defined cases: null or empty text: no spans, the digest of the empty string; repeated rows repeat; an
empty table gives an empty result (both models stay at their priors); extra columns are ignored. Offsets are
code points, end exclusive; spans that begin alike come in order of kind. A text of very many matches takes time in
proportion to them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import common
from .common import cut

BASE = ("email", "ip", "card", "phone")
ADDED = ("ssn", "iban", "local_phone", "hidden_email", "person")
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "hidden_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}+(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,63}+)++",
    "person": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]{1,20}+(?: [A-Z][a-z]{1,20}+)?",
}
#: Fixed values of the labelers.
FOR_WORDS = "(?i)(?:ssn|social security|iban|account|bank|call|phone|tel|mobile|fax|mail|contact|write to|dear|patient|signed)[^A-Za-z0-9]{0,12}$"
AGAINST_WORDS = r"(?i)(?:version|isbn|serial|part no|order|page|figure|build|invoice|item|section)[^A-Za-z0-9]{0,12}$"
GAZETTEER = {
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": "^(?:AT|BE|BG|CH|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IT|LI|LT|LU|LV|MC|MT|NL|NO|PL|PT|RO|SE|SI|SK)",
    "local_phone": r"^\(?[2-9][0-9]{2}",
    "hidden_email": "(?i)(?:com|org|net|edu|gov|io|de|fr|es|uk|eu)$",
    "person": "(?i) (?:smith|johnson|williams|brown|jones|garcia|miller|davis|martin|muller|schmidt|schneider|fischer|weber|dubois|bernard|thomas|robert|petit|gonzalez|rodriguez|fernandez|lopez|martinez|sanchez)$",
}
ACCEPT, CONTEXT, EM_STEPS, FIT_STEPS = 0.9, 24, 50, 300
#: Matches of a text that are worked on as one block.
BLOCK = 256
#: A text without any of these holds no match of the kind.
MARKS = {"email": ("@",), "phone": ("+",), "ssn": ("-",), "ip": (".",), "person": ("Mr", "Ms", "Dr", "Prof")}


def marked_parts(text: Column, pattern: str) -> Column:
    """The text cut at the matches: each part after the first is match, U+0002, rest."""
    return F.split(F.regexp_replace(text, pattern, "\x01$0\x02"), "\x01", -1)


def spans_of(parts: Column) -> Column:
    """array<struct<start, end, s, before, after>> from marked parts; null parts give null.

    Offsets are running sums; they are worked out by blocks of parts, as an array that grows by one at a time is copied each time.
    """
    kind = "array<struct<start:int,end:int,s:string,before:string,after:string>>"
    first = F.element_at(parts, 1)
    block = lambda b: F.slice(parts, 2 + BLOCK * b, BLOCK)
    sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 2) / BLOCK).cast("int")), lambda b: F.aggregate(block(b), F.lit(0), lambda a, p: a + F.length(p) - 1))
    begin = F.struct(F.length(first).alias("off"), F.array().cast("array<int>").alias("out"))
    offsets = F.aggregate(sums, begin, lambda a, n: F.struct((a["off"] + n).alias("off"), F.concat(a["out"], F.array(a["off"])).alias("out")), lambda a: a["out"])

    def step(a: Column, p: Column) -> Column:
        s = F.substring_index(p, "\x02", 1)
        end = a["off"] + F.length(s)
        rest = F.substring(p, F.length(s) + 2, F.length(p))
        span = F.struct(a["off"].alias("start"), end.alias("end"), s.alias("s"), a["before"].alias("before"), F.left(rest, F.lit(CONTEXT)).alias("after"))
        return F.struct((end + F.length(rest)).alias("off"), F.right(rest, F.lit(CONTEXT)).alias("before"), F.concat(a["out"], F.array(span)).alias("out"))

    def spans_in(off: Column, b: Column) -> Column:
        before = F.right(F.substring_index(F.element_at(parts, 1 + BLOCK * b), "\x02", -1), F.lit(CONTEXT))
        return F.aggregate(block(b), F.struct(off.alias("off"), before.alias("before"), F.array().cast(kind).alias("out")), step, lambda a: a["out"])

    return F.when(F.size(parts) > 1, F.flatten(F.transform(offsets, spans_in))).otherwise(F.array().cast(kind))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """Is the number of digits 16 to 19, and their Luhn sum a multiple of ten?"""

    def value(c: Column, i: Column) -> Column:
        v = c.cast("int")
        return F.when(i % 2 == 1, F.when(v > 4, 2 * v - 9).otherwise(2 * v)).otherwise(v)

    d = digits(s)
    total = F.aggregate(F.transform(F.split(F.reverse(d), "(?!^)(?!$)"), value), F.lit(0), lambda a, x: a + x)
    return F.when(F.length(d).between(16, 19), total % 10 == 0).otherwise(False)


def iban_ok(s: Column) -> Column:
    """Remainder of the rearranged number is 1, nine digits at a time."""
    plain = F.regexp_replace(s, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    number = F.array_join(F.transform(F.split(turned, "(?!^)(?!$)"), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")
    rest = F.aggregate(F.split(number, "(?!^)(?!$)"), F.lit(0), lambda a, c: (a * 10 + c.cast("int")) % 97)
    return rest == 1


def valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(s, "\\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return luhn(s)
    if kind == "phone":
        return F.length(digits(s)).between(8, 15)
    return F.lit(True)


def votes(kind: str, x: Column) -> Column:
    """struct of the labelers' votes: 1 for, -1 against, 0 none."""
    strict = {
        "ssn": F.lit(1), "iban": F.when(iban_ok(x["s"]), 1).otherwise(-1), "local_phone": F.when(x["s"].rlike(r"^\("), 1).otherwise(0),
        "hidden_email": F.when(x["s"].rlike(r"[\[(] ?dot"), 1).otherwise(-1), "person": F.when(x["s"].rlike(r"\. "), 1).otherwise(0),
    }
    return F.struct(
        strict[kind].cast("int").alias("pattern"),
        F.when(x["s"].rlike(GAZETTEER[kind]), 1).otherwise(-1 if kind in ("ssn", "iban") else 0).cast("int").alias("gazetteer"),
        F.when(x["before"].rlike(FOR_WORDS), 1).otherwise(0).cast("int").alias("context"),
        F.when(x["before"].rlike(AGAINST_WORDS), -1).otherwise(0).cast("int").alias("counter"),
    )


LABELERS = ("pattern", "gazetteer", "context", "counter")


def features(kind: str, x: Column) -> Column:
    """Categorical features of a span, few values each."""
    n = F.length(x["s"])
    return F.struct(
        F.lit(kind).alias("kind"),
        F.when(n < 12, "short").when(n < 24, "middle").otherwise("long").alias("length"),
        F.when(x["before"].rlike(r"[:=] ?$"), "sign").when(x["before"].rlike(r"\s$"), "blank").when(x["before"] == "", "start").otherwise("other").alias("left"),
        F.when(x["before"].rlike(FOR_WORDS), "for").when(x["before"].rlike(AGAINST_WORDS), "against").otherwise("none").alias("words"),
        F.when(x["s"].rlike(GAZETTEER[kind]), "known").otherwise("unknown").alias("listed"),
        F.when(iban_ok(x["s"]) if kind == "iban" else F.lit(True), "sound").otherwise("unsound").alias("check"),
        F.when(x["after"] == "", "end").when(x["after"].rlike(r"^[.,;!?)]"), "stop").when(x["after"].rlike(r"^\s"), "blank").otherwise("other").alias("right"),
        F.when(x["after"].rlike(r"^[.,;]?\s[a-z]"), "small").when(x["after"].rlike(r"^[.,;]?\s[A-Z]"), "capital").when(x["after"].rlike(r"^[.,;]?\s[0-9]"), "digit").otherwise("none").alias("next"),
        F.when(10 * F.length(digits(x["s"])) < 2 * n, "few").when(10 * F.length(digits(x["s"])) < 7 * n, "some").otherwise("most").alias("digits"),
    )


FEATURES = ("kind", "length", "left", "words", "listed", "check", "right", "next", "digits")


def reliabilities(counts: dict[tuple[int, ...], int]) -> tuple[float, dict[tuple[int, ...], float]]:
    """Expectation-maximisation with labelers independent given the truth: prior, and probability of each vote pattern."""
    if not counts:
        return 0.5, {}
    prior = 0.5
    # starting points: a labeler's vote is right four times in five, no vote says little
    p = [[{1: 0.5, 0: 0.4, -1: 0.1} for _ in LABELERS], [{1: 0.1, 0: 0.4, -1: 0.5} for _ in LABELERS]]
    post: dict[tuple[int, ...], float] = {}
    for _ in range(EM_STEPS):
        for v in counts:
            yes = prior * math.prod(p[0][j][x] for j, x in enumerate(v))
            no = (1 - prior) * math.prod(p[1][j][x] for j, x in enumerate(v))
            post[v] = yes / (yes + no)
        total = sum(counts.values())
        weight = sum(post[v] * c for v, c in counts.items())
        prior = min(0.99, max(0.01, weight / total))
        for j in range(len(LABELERS)):
            for side, own in ((0, lambda v: post[v]), (1, lambda v: 1 - post[v])):
                mass = {x: 4.0 * p0 for x, p0 in (((1, 0.5), (0, 0.4), (-1, 0.1)) if side == 0 else ((1, 0.1), (0, 0.4), (-1, 0.5)))}
                for v, c in counts.items():
                    mass[v[j]] += own(v) * c
                whole = sum(mass.values())
                p[side][j] = {x: m / whole for x, m in mass.items()}
    return prior, post


def fitted(rows: list[tuple[tuple[str, ...], float, float]]) -> dict[tuple[int, str], float]:
    """Logistic regression over categorical features; rows: (features, weight, share of positives). Keys: (feature, value); (-1, ""): the bias."""
    w: dict[tuple[int, str], float] = {(-1, ""): 0.0}
    total = sum(n for _, n, _ in rows) or 1.0
    for _ in range(FIT_STEPS):
        slope: dict[tuple[int, str], float] = {}
        for f, n, y in rows:
            keys = [(-1, ""), *enumerate(f)]
            z = max(-30.0, min(30.0, sum(w.get(k, 0.0) for k in keys)))
            g = n * (y - 1 / (1 + math.exp(-z)))
            for k in keys:
                slope[k] = slope.get(k, 0.0) + g
        for k, g in slope.items():
            w[k] = w.get(k, 0.0) + 2.0 * (g / total - 1e-3 * w.get(k, 0.0))
    return w


def score(w: dict[tuple[int, str], float], f: Column) -> Column:
    """The fitted classifier as an expression over a features struct."""
    z = F.lit(w.get((-1, ""), -10.0))
    for j, name in enumerate(FEATURES):
        for (i, value), weight in sorted(w.items()):
            if i == j:
                z = z + F.when(f[name] == value, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def each(kind: str, f) -> Column:
    """f(kind, x) over the spans of a kind's column."""
    return F.transform(kind, lambda x: f(kind, x))


def those(kind: str, f) -> Column:
    return F.filter(kind, lambda x: f(kind, x))


def text_of(kind: str, x: Column) -> Column:
    return F.concat_ws(":", F.lit(kind), x["start"], x["end"])


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts, digest and text of its spans."""
    t = F.translate(common.utf8(text), "\x01\x02", "\x03\x03")
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), t.alias("_t"))

    def parts(kind: str) -> Column:
        found = marked_parts(F.col("_t"), PATTERNS[kind])
        marks = [F.contains(F.col("_t"), F.lit(m)) for m in MARKS.get(kind, ())]
        return F.when(reduce(lambda a, b: a | b, marks), found).otherwise(F.array(F.lit(""))) if marks else found

    d = d.select("doc_id", *(parts(k).alias(k) for k in (*BASE, *ADDED)))
    d = d.select("doc_id", *(spans_of(F.col(k)).alias(k) for k in (*BASE, *ADDED)))
    thin = [those(k, lambda k, x: valid(k, x["s"])).alias(k) for k in BASE]
    found = cut(d.select("doc_id", *thin, *(each(k, lambda k, x: F.struct(x["start"].alias("start"), x["end"].alias("end"), votes(k, x).alias("votes"), features(k, x).alias("features"))).alias(k) for k in ADDED)))

    every = found.select(F.explode(F.concat(*(each(k, lambda k, x: F.struct(F.lit(k).alias("kind"), x["votes"].alias("votes"), x["features"].alias("features"))) for k in ADDED))).alias("x"))
    table = every.groupBy("x.kind", *(F.col(f"x.votes.{v}").alias(f"v_{v}") for v in LABELERS), *(F.col(f"x.features.{v}").alias(f"f_{v}") for v in FEATURES)).count().collect()
    rows: list[tuple[tuple[str, ...], float, float]] = []
    for kind in ADDED:
        own = [r for r in table if r["kind"] == kind]
        counts: dict[tuple[int, ...], int] = {}
        for r in own:
            v = tuple(r[f"v_{x}"] for x in LABELERS)
            counts[v] = counts.get(v, 0) + r["count"]
        _, post = reliabilities(counts)
        rows += [(tuple(r[f"f_{x}"] for x in FEATURES), float(r["count"]), post[tuple(r[f"v_{x}"] for x in LABELERS)]) for r in own]
    weights = fitted(rows) if rows else {}

    # base spans in order of start, by blocks with their reach, so that a candidate looks into few of them
    base_all = F.array_sort(F.concat(*(F.transform(k, lambda x: F.struct(x["start"].alias("a"), x["end"].alias("b"))) for k in BASE)))
    f = found.withColumn("_all", base_all)
    one = lambda i: F.slice("_all", 1 + BLOCK * i, BLOCK)
    reach = lambda i: F.struct(F.element_at("_all", 1 + BLOCK * i)["a"].alias("a"), F.array_max(F.transform(one(i), lambda b: b["b"])).alias("b"), one(i).alias("all"))
    f = f.withColumn("_base", F.when(F.size("_all") > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size("_all") - 1) / BLOCK).cast("int")), reach)))
    meets = lambda b, x: (b["a"] < x["end"]) & (x["start"] < b["b"])
    free = lambda x: ~F.coalesce(F.exists("_base", lambda k: meets(k, x) & F.exists(k["all"], lambda b: meets(b, x))), F.lit(False))
    added = {k: those(k, lambda k, x: (score(weights, x["features"]) >= ACCEPT) & free(x)) if weights else F.slice(k, 1, 0) for k in ADDED}
    f = f.select("doc_id", *BASE, *(v.alias(k) for k, v in added.items()))
    base_text = F.concat(*(each(k, text_of) for k in BASE))
    more_text = F.concat(*(each(k, text_of) for k in ADDED))
    return f.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(F.array_join(base_text, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base_text, more_text), ",").alias("spans"),
        reduce(lambda a, b: a + b, (F.size(k) for k in ADDED)).cast("long").alias("n_added"),
    )


def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(common.table(spark, sf_dir, "documents"))
