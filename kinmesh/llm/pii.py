"""Personal data, found with DataFrame functions only.

Regular expressions propose spans, validators (digit counts, octet ranges, Luhn,
mod-97) confirm them, and words near a span adjust its score.  Offsets are code
points, end exclusive.

Base kinds, leftmost and non-overlapping within a kind, each match kept or dropped
as a whole: email, ip, card, phone.  Added kinds: iban (mod-97 confirms it), ssn and
secret, an opaque string of letters and digits (both only where a context word stands
nearby).  Context is the text between a match and its neighbours of the same kind, on
both sides, CONTEXT characters at most.  A base span is kept whatever its score; an added
one needs `min_score`.

Defined results: a null or empty text has no spans; rows that repeat a doc_id, or
have none, are judged row by row; an empty table gives no rows; further columns are
carried along.

The patterns match what the plain ones in KINDS' comments match.  They use
possessive repetition, which Java runs without recursion, so a text of a million
digits or labels overflows no stack; and an email starts where a run of its
characters does, or where the last match ended, so long runs cost linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind: (pattern, cheap test that every text with a match passes)
KINDS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(text, '@')"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"text rlike '[0-9][.][0-9]+[.][0-9]+[.][0-9]'"),
    # [0-9]([\x20-]?[0-9])+
    "card": (r"[0-9](?:[ -]?[0-9])++", r"text rlike '(?:[0-9][ -]?){15}[0-9]'"),
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", r"text rlike '[+][0-9]'"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"text rlike '[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}'"),
    "ssn": (r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", r"text rlike '[0-9]{3}-[0-9]{2}-[0-9]{4}'"),
    "secret": (r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z])[A-Za-z0-9_+/=-]{20,}+", r"text rlike '[A-Za-z0-9_+/=-]{20}'"),
}
BASE = ("email", "ip", "card", "phone")
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
#: kind: (score of a confirmed match, score it gains beside one of the words)
SCORES = {
    "email": (0.9, 0.1, "mail|e-mail|contact|write"),
    "ip": (0.6, 0.3, "ip|address|host|server"),
    "card": (0.8, 0.2, "card|visa|credit|payment|mastercard"),
    "phone": (0.7, 0.2, "phone|call|tel|mobile|fax"),
    "iban": (0.9, 0.1, "iban|account|bank"),
    "ssn": (0.3, 0.5, "ssn|social security"),
    "secret": (0.3, 0.5, "token|secret|password|passwd|credential|credentials|key|apikey|api_key|access_key|bearer|authorization"),
}
CONTEXT, RUN = 40, 256
SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled and cast out by nine, is a multiple of ten."""
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """The first four characters moved to the end, letters read as 10 to 35: 1 modulo 97."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(r, i):
        c = F.substring(moved, i, F.lit(1))
        v = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(v < 10, r * 10 + v).otherwise(r * 100 + v) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(OCTETS)
    if kind == "card":
        d = _digits(m)
        return F.length(d).between(16, 19) & F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    if kind == "iban":
        code = F.replace(m, F.lit(" "), F.lit(""))
        return F.length(code).between(15, 34) & F.when(F.length(code).between(15, 34), mod97(code)).otherwise(F.lit(False))
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """body over a value that is computed once: what a lambda refers to is else computed at each of its calls."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sums(steps: Column) -> Column:
    """Running sums of an array, in runs of RUN: each append copies its run, so cost stays linear."""
    runs = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / RUN).cast("int"))
    run = lambda b: F.slice(steps, b * RUN + 1, RUN)
    more = lambda a, x: F.array_append(a, F.element_at(a, -1) + x)
    totals = F.transform(runs, lambda b: F.aggregate(run(b), F.lit(0), lambda a, x: a + x))
    starts = F.aggregate(totals, F.array(F.lit(0)), more)
    return _let(starts, lambda s: F.flatten(F.transform(runs, lambda b: F.slice(F.aggregate(run(b), F.array(F.get(s, b)), more), 2, RUN))))


def _placed(kind: str, m: Column, gaps: Column) -> Column:
    """Confirmed matches as (kind, start, end, score).  gaps: the texts before, between and after the matches."""
    base, gain, words = SCORES[kind]
    places = F.sequence(F.lit(0), F.size(m) - 1)
    near = rf"(?i)(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"

    def one(i, ends):
        end, match = F.get(ends, i), F.get(m, i)
        context = F.substring(F.get(gaps, i), -CONTEXT, CONTEXT).rlike(near) | F.substring(F.get(gaps, i + 1), 1, CONTEXT).rlike(near)
        score = F.lit(base) + F.when(context, F.lit(gain)).otherwise(F.lit(0.0))
        return F.when(_confirmed(kind, match), F.struct(F.lit(kind).alias("kind"), (end - F.length(match)).cast("long").alias("start"), end.cast("long").alias("end"), score.alias("score")))

    steps = F.transform(places, lambda i: F.length(F.get(gaps, i)) + F.length(F.get(m, i)))
    spans = _let(steps, lambda w: _let(_sums(w), lambda ends: F.transform(places, lambda i: one(i, ends))))
    return F.when(F.size(m) > 0, F.filter(spans, lambda x: x.isNotNull())).otherwise(F.array().cast(SPANS))


def find(docs: DataFrame, min_score: float = 0.6) -> DataFrame:
    """docs with `pii`: array of (kind, start, end, score), by kind as listed, then by start.

    An input column named pii is replaced; no other name clashes."""
    own = [c for c in docs.columns if c not in ("text", "pii")]
    of = "__of"
    while of in own:
        of += "_"
    out = docs.select(*own, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # one text scan a kind; only texts that pass the cheap test are matched
    none = F.array().cast("array<string>")
    found = [F.when(F.expr(test), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none).alias(k) for k, (p, test) in KINDS.items()]
    out = out.select(*own, "text", F.struct(*found).alias(of))
    gaps = [F.when(F.size(f"{of}.{k}") > 0, F.split("text", p, -1)).alias(f"{k}_gaps") for k, (p, _) in KINDS.items()]
    out = out.select(*own, "text", F.struct(*[F.col(f"{of}.{k}") for k in KINDS], *gaps).alias(of))
    placed = {k: _placed(k, F.col(f"{of}.{k}"), F.col(f"{of}.{k}_gaps")) for k in KINDS}
    spans = [p if k in BASE else F.filter(p, lambda s: s["score"] >= min_score) for k, p in placed.items()]
    return out.select(*own, "text", F.concat(*spans).alias("pii"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, min_score: float = 0.6) -> DataFrame:
    """docs whose texts hold [kind] in place of each span; of overlapping spans the first placed wins."""
    found = find(docs, min_score)
    ordered = F.array_sort(F.transform("pii", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def put(acc, s):
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.when(s["start"] < acc["at"], acc).otherwise(F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]")).alias("out")))

    end = F.aggregate(ordered, zero, put, lambda a: F.concat(a["out"], F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.length("text"))))
    return found.withColumn("text", end).select(*[c for c in docs.columns])


def query(docs: DataFrame) -> DataFrame:
    found = find(docs.select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    counts = [F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in BASE]  # noqa: B023
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"), F.array_join(F.transform("pii", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"))
