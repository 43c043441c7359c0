"""The corpus pipeline: five stages over `documents`, each written as Parquet and read back.

Every stage takes (spark, docs, sf_dir) and works on all that the stage
before it kept; all but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import bpe, decontaminate, language_id, line_dedup, near_dedup
from tidemart.llm.common import table, unused, written

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4, fitted on the labelled documents. A text without a letter goes; so does one whose
    best language is less likely than the others together, and one far less likely, n-gram by
    n-gram, than that language's labelled texts: gibberish, or a language that was not learned."""
    model = language_id.fit(docs)
    name, score = unused(docs, "_lang", "_score")
    judged = language_id.predict(docs, model, name=name, score=score)
    named = judged.filter((F.col(name) != language_id.UNKNOWN) & (F.col(score) >= 0.5))
    return language_id.drop_untypical(named, model, name).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: recurring template lines go from the texts; every document stays."""
    cut = line_dedup.drop_recurring_lines(docs).drop("n_lines", "n_dropped")
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5 at a similarity of 0.8: of each group the smallest doc_id stays.

    Documents without words and rows with a null doc_id link with nothing and
    stay. Of rows that repeat a doc_id and its text the smallest by the other
    columns stays; its other texts are documents of their own and stay too.
    """
    name = unused(docs, "_kept")[0]
    kept = (near_dedup.near_duplicates(docs, percent=80).filter("kept AND doc_id IS NOT NULL")
            .select(F.col("doc_id").alias(name)).distinct())
    named = docs.filter("doc_id IS NOT NULL").join(kept, F.col("doc_id") == F.col(name), "left_semi")
    others = F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")])
    first = named.groupBy("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias(name)).agg(F.min(F.struct(others.alias("o"), "text")).alias("m"))
    once = first.select(*[F.col(c) if c == "doc_id" else F.col("m.text") if c == "text" else F.col(f"m.o.{c}") for c in docs.columns])
    return once.unionByName(docs.filter("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: a document that shares a verified passage with a benchmark item goes."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the ids of every text, and the text decoded from them."""
    path = public_tokenizers.path(VOCABULARY)
    coded = bpe.encode(docs, path, decoded="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [("language_id", language), ("line_dedup", lines), ("near_dedup", near_copies),
          ("decontamination", decontamination), ("bpe", tokens)]

#: Fitted probabilities, likelihood estimates and merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the `documents` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
