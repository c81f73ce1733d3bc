"""Operator 4: personal data by bootstrapped contextual extraction (DataFrame functions only).

Base entities (email, ip, card, phone) are the seeds. Everywhere a word comes
right before a base entity or an identifier-shaped token, the word is a lexical
pattern and the whole entity or token an instance: a bipartite graph with counts on its edges. Scores go back
and forth for ``ROUNDS`` rounds: a pattern's confidence is the share of all its
occurrences in the corpus that stand before confident instances, an instance's
the noisy-or of the patterns it follows (1 for seeds). Patterns of high
confidence and support then reveal identifiers no base rule knows; they are
the spans of kind ``context``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored

ROUNDS = 3
CONFIDENT = 0.8  # of a pattern that reveals, and of an instance that is revealed
SUPPORT = 3  # distinct confident instances of such a pattern
TRUST = 0.95  # of a pattern's confidence that passes on to an instance

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
NAMED = "array<struct<kind:string,start:bigint,end:bigint,before:string,token:string,at:bigint>>"
SEEN = "array<struct<at:bigint,shaped:boolean,before:string,token:string,start:bigint,end:bigint>>"

# The base kinds in their order, a text's quick look, pattern.
# \G or the look-behind start a match where a run of its characters starts (or
# the last match ended), which is where the leftmost match starts anyway;
# possessive groups keep long runs off the stack.
BASE = [
    ("email", "@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", ".", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", None, r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", "+", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
DIGIT = "[0-9]"
WORD = r"[\p{L}_]+[:=#]?"
# A word, then (over a sign, blanks or quotes) a token of 6 characters at least with a digit or @.
LABEL = r"[\p{L}_]++[:=#]?[\x20\t\"'(]{1,3}"
BEFORE = rf"(?<![\p{{L}}_]){LABEL}(?=[A-Za-z._%+/-]*+[0-9@])\+?[A-Za-z0-9][A-Za-z0-9@._%+/-]{{5,}}+"
LEAD = rf"(?<![\p{{L}}_]){LABEL}\+?\z"  # the end of what stands before a base entity


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        bare = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(match, "[.]"), lambda p: (F.length(bare(p)) < 3) | ((F.length(bare(p)) == 3) & (bare(p) <= "255")))
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(16, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(lengths: Column) -> Column:
    """Running sums of an array of bigint, itself included: each step adds what
    lies 1, 2, 4, ... places before, so n numbers take n log n additions."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(lengths), F.lit(1)))).cast("int"))
    return F.aggregate(
        steps, lengths,
        lambda sums, k: F.transform(sums, lambda s, i: s + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0).cast("long"))),
    )


def _matches(text: Column, pattern: str, item: Callable[[Column, Column, Column], Column], keep: Callable[[Column], Column], kind: str) -> Column:
    """Array of ``item(match, start, lead)`` over the pattern's matches that pass
    ``keep``, in order; the lead is the match before, or the text's start, and
    all between. Starts are running sums over the pieces between matches."""
    found = F.filter(
        F.zip_with(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1),
            lambda m, gap: F.struct(m.alias("m"), gap.alias("gap")),
        ),
        lambda x: x["m"].isNotNull(),
    )

    def placed(f: Column, ends: Column) -> Column:
        led = F.zip_with(
            F.arrays_zip(f.alias("f"), ends.alias("e")), F.concat(F.array(F.lit("")), F.transform(f, lambda x: x["m"])),
            lambda x, last: F.struct(x["f"]["m"].alias("m"), (x["e"] - F.length(x["f"]["m"])).alias("start"), F.concat(last, x["f"]["gap"]).alias("lead")),
        )
        kept = F.filter(led, lambda x: x["m"].isNotNull() & keep(x["m"]))  # the last match leads nothing
        return F.transform(kept, lambda x: item(x["m"], x["start"], x["lead"])).cast(kind)

    lengths = lambda f: F.transform(f, lambda x: (F.length(x["gap"]) + F.length(x["m"])).cast("long"))
    return _bound(found, lambda f: _bound(_running(lengths(f)), lambda ends: placed(f, ends)))


def base_spans(text: Column) -> Column:
    """Base entities of a text that is not null, by kind as listed, then start:
    kind, start, end, the word ``before`` (empty if none), the entity as
    ``token``, and ``at`` where the word's label ends."""

    def item(kind: str) -> Callable[[Column, Column, Column], Column]:
        def named(m: Column, start: Column, lead: Column) -> Column:
            label = F.regexp_extract(lead, LEAD, 0)
            before = F.lower(F.regexp_extract(label, "^" + WORD, 0))
            at = start - F.endswith(label, F.lit("+")).cast("int")
            return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), before.alias("before"), m.alias("token"), at.alias("at"))

        return named

    parts = []
    for kind, sign, pattern in BASE:
        quick = F.contains(text, F.lit(sign)) if sign else text.rlike(DIGIT)
        spans = _matches(text, pattern, item(kind), lambda m, kind=kind: _valid(kind, m), NAMED)
        parts.append(F.when(quick, spans).otherwise(F.expr(f"cast(array() as {NAMED})")))
    return F.concat(*parts)


def shaped_tokens(text: Column) -> Column:
    """Identifier-shaped tokens (four digits at least, or an @) and the word before each."""

    def raw(m: Column) -> Column:
        return F.regexp_replace(m, "^" + LABEL, "")

    def token(m: Column) -> Column:
        return F.regexp_replace(raw(m), r"(?<![._%+/-])[._%+/-]++\z", "")

    def item(m: Column, at: Column, _: Column) -> Column:
        start = at + F.length(m) - F.length(raw(m))
        before = F.lower(F.regexp_extract(m, "^" + WORD, 0))
        return F.struct(
            start.alias("at"), F.lit(True).alias("shaped"), before.alias("before"), token(m).alias("token"),
            start.alias("start"), (start + F.length(token(m))).alias("end"),
        )

    def keep(m: Column) -> Column:
        return F.contains(token(m), F.lit("@")) | (F.length(_digits(token(m))) >= 4)

    quick = text.rlike("[0-9@]")
    return F.when(quick, _matches(text, BEFORE, item, keep, SEEN)).otherwise(F.expr(f"cast(array() as {SEEN})"))


def bootstrap(seen: DataFrame, totals: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Confidence of patterns (before, confidence, support) and of instances
    (token, confidence) after some rounds. ``seen`` has one row per occurrence
    (before, token, seed), ``totals`` the occurrences of each word (before, total)."""
    edges = seen.groupBy("before", "token").agg(F.count(F.lit(1)).alias("n"))
    edges = stored(edges.join(totals, "before", "left").withColumn("total", F.greatest(F.coalesce("total", "n"), "n")), "pii_edges")
    seeds = seen.groupBy("token").agg(F.max("seed").alias("seed"))
    seeds = stored(seeds, "pii_seeds")
    instances = seeds.withColumn("confidence", F.col("seed").cast("double"))
    for last in (i == rounds - 1 for i in range(rounds)):
        patterns = (
            edges.join(instances, "token")
            .groupBy("before")
            .agg(
                (F.sum(F.col("n") * F.col("confidence")) / F.greatest(F.max("total"), F.sum("n"))).alias("confidence"),
                F.count_if(F.col("confidence") >= CONFIDENT).alias("support"),
            )
        )
        sure = patterns.filter((F.col("confidence") >= CONFIDENT) & (F.col("support") >= SUPPORT))
        if last:  # the rounds before are one short chain of joins, run once
            sure = stored(sure, "pii_patterns")
        told = (
            edges.join(sure.select("before", F.col("confidence").alias("p")), "before")
            .groupBy("token")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("p"), F.lit(1.0)) * TRUST)))).alias("told"))
        )
        instances = seeds.join(told, "token", "left").select(
            "token", "seed", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.coalesce("told", F.lit(0.0))).alias("confidence")
        )
    return sure, instances


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` (base spans: kind,
    start, end in code points, end exclusive) and ``context`` (spans that
    patterns reveal and no base span meets), each by start within its kind.

    Null and empty texts have no spans. Rows that repeat get the same spans;
    rows with equal ids but other texts are told apart by their text, rows
    without an id too. Other columns of ``docs`` are not used."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    read = stored(
        given.select(
            "doc_id", F.xxhash64("text").alias("text_hash"),
            base_spans(F.col("text")).alias("base"), shaped_tokens(F.col("text")).alias("shaped"),
        )
        .withColumn(
            "seen",
            F.array_sort(F.concat(
                F.transform(
                    F.filter("base", lambda b: b["before"] != ""),
                    lambda b: F.struct(b["at"].alias("at"), F.lit(False).alias("shaped"), b["before"].alias("before"), b["token"].alias("token"), b["start"].alias("start"), b["end"].alias("end")),
                ).cast(SEEN),
                F.col("shaped"),
            )),
        )
        .withColumn("base", F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end"))).cast(SPANS))
        .drop("shaped"),
        "pii_spans",
    )
    # A label has one instance: the first base entity that starts there, or else the token.
    single = F.filter("seen", lambda x, i: (i == 0) | (F.get(F.col("seen"), i - 1)["at"] != x["at"]))
    meets = F.exists("base", lambda b: (b["start"] < F.col("s.end")) & (b["end"] > F.col("s.start")))
    seen = read.select("doc_id", "text_hash", "base", F.explode(single).alias("s")).select(
        "doc_id", "text_hash", "s.before", "s.token", "s.start", "s.end", (~F.col("s.shaped")).alias("seed"), meets.alias("met")
    )
    words = given.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("before"))
    totals = words.groupBy("before").agg(F.count(F.lit(1)).alias("total"))
    patterns, instances = bootstrap(seen, totals)
    revealed = (
        seen.filter(~F.col("met"))
        .join(patterns.select("before"), "before")
        .join(instances.filter((F.col("confidence") >= CONFIDENT) & ~F.col("seed")).select("token"), "token")
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set(F.struct(F.lit("context").alias("kind"), "start", "end"))).alias("context"))
        .withColumnsRenamed({"doc_id": "of_id", "text_hash": "of_hash"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
    return read.join(revealed, same, "left").select(
        "doc_id", "base", F.coalesce("context", F.expr(f"cast(array() as {SPANS})")).alias("context")
    )


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def personal_digests(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans, per document."""
    found = personal_data(docs)

    def n(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[n(kind) for kind, _, _ in BASE],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat("base", "context")).alias("spans"),
    )
