"""Operator 10: mixing sources to target weights by hierarchical budgeting.

The sources are leaves of a tree (domain, language, source). The token budget
of the root is split among children in proportion to their weights; a child
whose documents cannot fill its part (all epochs used) keeps what it has, and
the shortage goes to its siblings first, to the siblings of its parent only
when all of them are full. That is water filling, level by level from the
root, with the capacity of whole subtrees. Each leaf then takes a prefix, up
to its budget, of its documents in seeded order, epoch after epoch.

A prefix over a hot leaf is summed in two steps: documents fall into ranges
of the order's hash whose sums are running totals over at most ``RANGES`` rows
a leaf and epoch, and only the range that holds the cut is ordered document
by document.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored

EPOCHS = 2
SHARE = 0.8  # of all tokens, as the budget
# Target weights of the production mix; a name without a weight has 1.
WEIGHTS = {"lang": {"en": 2, "de": 3, "fr": 3, "es": 3}}
SEED = "mix-1"
RANGES = 4096
LEVELS = ("domain", "lang", "source")


@dataclass
class Plan:
    """Integer weights by level and name (1 where none is given), epochs a
    document may be used, and the budget as a share of all tokens."""

    weights: dict[str, dict[str, int]] = field(default_factory=lambda: WEIGHTS)
    epochs: int = EPOCHS
    share: float = SHARE
    seed: str = SEED


def tokens_of(text: str) -> Column:
    """Words of a text: runs of anything but blanks, tabs and line ends."""
    flat = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[ \t\r\n]+", " "))
    return F.when(flat == "", F.lit(0)).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def domain_of(source: str) -> Column:
    """Domain of a source: numbered sources form one domain per five numbers,
    another source is its own."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    group = F.floor(F.try_to_number(number, F.lit("999999999")) / 5).cast("string")
    return F.when(number == "", F.col(source)).otherwise(F.concat(F.regexp_replace(source, "[0-9]+$", ""), F.lit("-"), group))


def _weight(level: str, plan: Plan) -> Column:
    named = plan.weights.get(level, {})
    out = F.lit(1)
    for name, weight in named.items():
        out = F.when(F.col(level) == name, F.lit(int(weight))).otherwise(out)
    return out.cast("long")


def fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Split each parent's ``budget`` among its children (``capacity``, ``weight``):
    a child is full when the level water reaches its capacity per weight."""
    order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    family = Window.partitionBy(*parent)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    return (
        nodes.withColumn("pos", F.row_number().over(order))
        .withColumn("left", F.greatest(F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)), F.lit(0)))
        .withColumn("heavy", F.sum("weight").over(onward))
        # By fullness, the first child that is not full sets the level for itself and all after it.
        .withColumn("stop", F.min(F.when(wide("capacity") * F.col("heavy") > wide("left") * F.col("weight"), F.col("pos"))).over(family))
        .withColumn("left", F.max(F.when(F.col("pos") == F.col("stop"), F.col("left"))).over(family))
        .withColumn("heavy", F.max(F.when(F.col("pos") == F.col("stop"), F.col("heavy"))).over(family))
        .withColumn("part", F.floor(wide("left") * F.col("weight") / F.col("heavy")).cast("long"))
        .withColumn("budget", F.when(F.col("pos") >= F.col("stop"), F.least("capacity", "part")).otherwise(F.col("capacity")))
        .drop("pos", "left", "heavy", "stop", "part")
    )


def budgets(leaves: DataFrame, plan: Plan) -> DataFrame:
    """domain, lang, source, tokens and ``budget`` of every leaf (``tokens``
    summed); rounding loses less than one token a node."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * plan.epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"))
    nodes = total.select(F.floor(F.col("all") * F.lit(plan.share)).cast("long").alias("budget"))
    above: list[str] = []
    for level in LEVELS:
        keys = [*above, level]
        children = leaves.groupBy(*keys).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        children = children.withColumn("weight", _weight(level, plan))
        joined = children.join(nodes.select(*above, "budget"), above) if above else children.join(nodes, F.lit(True))
        nodes = fill(joined.withColumn("root", F.lit(0)), above or ["root"], level).drop("root")
        above = keys
    return nodes.select(*LEVELS, "tokens", "budget")


def mixture(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """One row per use of a document: ``doc_id``, ``domain``, ``lang``,
    ``source``, ``epoch`` (from 1), ``n_tokens`` and ``text_hash``.

    Documents of a leaf are ordered, in each epoch, by a 60-bit hash of seed,
    epoch and id, then text hash; the leaf takes those whose running total of
    tokens over all epochs stays within its budget. Null languages and sources
    are the empty name; documents without a token are not used. A row that
    repeats is a document of its own; ties are taken or left together with
    their running total, so equal rows share its end. A weight of 0 or less
    is an error."""
    plan = plan or Plan()
    if any(w <= 0 for named in plan.weights.values() for w in named.values()):
        raise ValueError("weights must be positive")
    text = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
    )
    rows = stored(
        text.select(
            "doc_id", domain_of("source").alias("domain"), "lang", "source",
            tokens_of("text").alias("n_tokens"), F.xxhash64("text").alias("text_hash"),
        ),
        "mix_rows",
    ).filter("n_tokens > 0")  # fmt: skip  # on the table: before it, the words would be counted again for the filter
    leaf = stored(budgets(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), plan), "mix_budgets")
    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(plan.seed), "epoch", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.col("text_hash"))))), 1, 15), 16, 10).cast("long")
    epochs = F.explode(F.sequence(F.lit(1), F.ceil(F.col("budget") / F.col("tokens")).cast("int")))
    used = rows.join(leaf.filter("budget > 0"), list(LEVELS)).withColumn("epoch", epochs)
    used = used.withColumn("place", place).withColumn("span", F.floor(F.col("place") / F.lit((1 << 60) // RANGES)).cast("int"))
    whole = (F.col("epoch") * F.col("tokens")) <= F.col("budget")
    columns = ["doc_id", *LEVELS, "epoch", "n_tokens", "text_hash"]
    last = used.filter(~whole).withColumn("rest", F.col("budget") - (F.col("epoch") - 1) * F.col("tokens"))
    sums = last.groupBy(*LEVELS, "epoch", "span").agg(F.sum("n_tokens").alias("of_span"))
    until = Window.partitionBy(*LEVELS, "epoch").orderBy("span").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("of_span").over(until))
    placed = last.join(sums, [*LEVELS, "epoch", "span"])
    inside = placed.filter(F.col("upto") <= F.col("rest"))
    # The range that the budget ends in, of each leaf: 1 / RANGES of its documents.
    cut = placed.filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("of_span") < F.col("rest")))
    by = Window.partitionBy(*LEVELS, "epoch").orderBy("place", "text_hash")
    cut = cut.withColumn("run", F.col("upto") - F.col("of_span") + F.sum("n_tokens").over(by)).filter(F.col("run") <= F.col("rest"))
    return used.filter(whole).select(*columns).unionByName(inside.select(*columns)).unionByName(cut.select(*columns))


def mixture_sql(docs: str = "documents", plan: Plan | None = None) -> str:
    """DuckDB SQL for ``mixture`` of a table whose ids are not null and differ."""
    plan = plan or Plan()

    def weight(level: str) -> str:
        cases = "".join(f" WHEN '{name}' THEN {w}" for name, w in plan.weights.get(level, {}).items())
        return f"(CASE {level}{cases} ELSE 1 END)" if cases else "1"

    def level(n: int) -> str:
        keys, above = ", ".join(LEVELS[: n + 1]), ", ".join(LEVELS[:n])
        by = f"PARTITION BY {above} " if n else ""
        using = f"JOIN b{n - 1} USING ({above})" if n else "CROSS JOIN top"
        return f"""
n{n} AS (SELECT {keys}, {weight(LEVELS[n])} AS weight, sum(capacity)::BIGINT AS capacity FROM leaves GROUP BY ALL),
f{n} AS (SELECT {keys}, capacity, weight,
    greatest(budget - coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS rest,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy,
    row_number() OVER o AS pos
  FROM n{n} {using} WINDOW o AS ({by}ORDER BY capacity::DOUBLE / weight, {LEVELS[n]})),
g{n} AS (SELECT *, min(CASE WHEN capacity::HUGEINT * heavy > rest::HUGEINT * weight THEN pos END) OVER ({by}) AS stop FROM f{n}),
h{n} AS (SELECT *, max(CASE WHEN pos = stop THEN rest END) OVER ({by}) AS r, max(CASE WHEN pos = stop THEN heavy END) OVER ({by}) AS w FROM g{n}),
b{n} AS (SELECT {keys}, CASE WHEN pos >= stop THEN least(capacity, (r::HUGEINT * weight // w)::BIGINT) ELSE capacity END AS budget FROM h{n})"""

    flat = "trim(regexp_replace(coalesce(text, ''), '[ \\t\\r\\n]+', ' ', 'g'))"
    return f"""
WITH s AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {flat} AS flat,
    regexp_extract(coalesce(source, ''), '[0-9]{{1,9}}$') AS number
  FROM {docs}),
d AS (
  SELECT doc_id, lang, source, len(flat) - len(replace(flat, ' ', '')) + 1 AS n_tokens,
    CASE WHEN number = '' THEN source ELSE regexp_replace(source, '[0-9]+$', '') || '-' || (number::BIGINT // 5) END AS domain
  FROM s WHERE flat <> ''),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * {plan.epochs})::BIGINT AS capacity FROM d GROUP BY ALL),
top AS (SELECT floor(sum(tokens) * {plan.share})::BIGINT AS budget FROM leaves),{level(0)},{level(1)},{level(2)},
u AS (SELECT d.*, epoch, budget,
    ('0x' || substr(md5('{plan.seed}|' || epoch || '|' || doc_id), 1, 15))::BIGINT AS place
  FROM d JOIN b2 USING (domain, lang, source) CROSS JOIN (SELECT unnest(range(1, {plan.epochs} + 1)) AS epoch)),
t AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY epoch, place) AS run FROM u)
SELECT doc_id, domain, lang, source, epoch::INTEGER AS epoch, n_tokens::BIGINT AS n_tokens FROM t WHERE run <= budget"""
