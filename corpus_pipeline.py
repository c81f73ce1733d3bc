"""Training-corpus pipeline over ``documents``: toxic documents go, one of
each class of near copies stays, documents that hold benchmark items go,
secrets are masked, and the rest is mixed to the target weights.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the next one's ``docs``. All stages but the last return the
columns of ``docs``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.decontamination import without_benchmark
from footfall.llm.mixing import mixture
from footfall.llm.near_copies import near_copies
from footfall.llm.secrets import masked_texts
from footfall.llm.toxicity import REJECT, fit, toxicity
from footfall.session import scratch_path
from footfall.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below the rejection score; learnt from a bounded
    sample of the labelled rows. Null and empty texts score as the empty text,
    and rows that repeat score alike."""
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity(docs, model, score_col="_toxicity")
    return scored.filter(F.col("_toxicity") < REJECT).select(*docs.columns)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies: the one with the smallest id, then
    text hash; rows without an id come last. Texts without words are no copies
    and stay."""
    classes = near_copies(docs).filter(F.col("class_key").isNotNull())
    name = [F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")]
    gone = classes.filter(~F.col("first")).select(*name).distinct()
    again = classes.filter("first").groupBy(*name).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    same = docs.doc_id.cast("long").eqNullSafe(F.col("of_id")) & (F.xxhash64(docs.text.cast("string")) == F.col("of_hash"))
    repeated = docs.join(again, same).dropDuplicates(["of_id", "of_hash"])
    return docs.join(gone.unionByName(again), same, "left_anti").unionByName(repeated.select(*docs.columns))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item. Null and empty texts hold none; rows that
    repeat stay or go together."""
    return without_benchmark(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their secrets replaced by a mask; ``n_chars`` counts the new
    text. Null and empty texts, and rows without a secret, stay as they are."""
    found = masked_texts(docs, out_col="_masked")
    new = {"text": F.coalesce("_masked", "text"), "n_chars": F.coalesce(F.length("_masked").cast("long"), "n_chars")}
    return found.withColumns(new).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, by epoch, of the weighted mix; see ``mixture`` for nulls, empty
    texts and rows that repeat."""
    return mixture(docs).drop("text_hash")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_copies", one_of_each_class),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("mixing", mix),
]

#: Scores of a trained model decide in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    root = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = os.path.join(root, name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
