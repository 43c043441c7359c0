"""The registered queries: each applies its operator to its whole table and
derives the result's digest columns from the operator's real output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (bpe, decontaminate, fingerprints, language_id, line_dedup, near_dedup, quote_links, ranked_search, sharding,
               suffix_dedup, token_binary, turn_repair, vector_dedup)
from .common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its recurring template lines."""
    cut = line_dedup.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that share a passage, with the overlap's place."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents into bit-plane files, read them back, digest the ids."""
    path = scratch_path(spark, "token-ids")
    token_binary.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_binary.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on documents whose crc32(doc_id) mod 4 is not 2; predict every document."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))
    model = language_id.fit(docs.filter(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by a similarity of at least 0.85."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near-equal bytes; equal texts share a shard."""
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that also start earlier."""
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, compared."""
    docs = fingerprints.fingerprint_with_next(table(spark, sf_dir, "documents"))
    return docs.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document by the rank file, decode the ids, digest both."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(table(spark, sf_dir, "documents"), path, decoded="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


#: Turns of one conversation; a message's id is conv_id * MOST_TURNS + turn.
MOST_TURNS = 1_000_000


def quoted_archive(conversations: DataFrame) -> DataFrame:
    """The conversations as a mail archive: each turn quotes the one before it, and that one's own quotation.

    Null texts read as empty. Turns are joined by their numbers, so a long
    conversation is not gathered anywhere.
    """
    turns = (conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
             .groupBy("conv_id", "turn").agg(F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), "role")).alias("m"))
             .select("conv_id", "turn", "m.text", "m.role"))

    def quote(column: str, mark: str):
        return F.array_join(F.transform(F.split(column, "\n"), lambda line: F.concat(F.lit(mark), line)), "\n")

    one = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("one"))
    two = turns.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("text").alias("two"))
    return turns.join(one, ["conv_id", "turn"], "left").join(two, ["conv_id", "turn"], "left").select(
        (F.col("conv_id") * MOST_TURNS + F.col("turn")).alias("id"), "conv_id", F.col("turn").alias("at"), "role",
        F.concat_ws("\n", quote("two", ">> "), quote("one", "> "), "text").alias("text"))


def op10_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations rebuilt from the quotations alone (conv_id only scopes the join)."""
    archive = quoted_archive(table(spark, sf_dir, "conversations"))
    chat = quote_links.link_quotes(archive, scope="conv_id")
    return chat.select("id", "conversation", "reply_to", F.col("depth").cast("long"), "turn", "role",
                       F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


#: The replies that the archive's construction implies, as SQL over the `conversations` view.
OP10_SQL = f"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, m.text AS text, m.role AS role, trim(regexp_replace(lower(m.text), '[[:space:]]+', ' ', 'g')) AS flat
  FROM (SELECT conv_id, turn, min({{'text': coalesce(text, ''), 'role': role}}) AS m FROM conversations
        WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn)),
first AS (SELECT conv_id, flat, min(turn) AS turn FROM turns WHERE flat <> '' GROUP BY conv_id, flat),
links AS (
  SELECT t.conv_id, t.turn, f.turn AS parent, t.turn - q.turn AS level
  FROM turns t JOIN turns q ON q.conv_id = t.conv_id AND q.turn IN (t.turn - 1, t.turn - 2)
  JOIN first f ON f.conv_id = q.conv_id AND f.flat = q.flat WHERE f.turn < t.turn),
replies AS (SELECT conv_id, turn, arg_min(parent, level) AS parent FROM links GROUP BY conv_id, turn),
chain AS (
  SELECT conv_id, turn, turn AS root, 0 AS depth FROM turns t
  WHERE NOT EXISTS (SELECT 1 FROM replies r WHERE r.conv_id = t.conv_id AND r.turn = t.turn)
  UNION ALL
  SELECT r.conv_id, r.turn, c.root, c.depth + 1 FROM chain c JOIN replies r ON r.conv_id = c.conv_id AND r.parent = c.turn)
SELECT t.conv_id * {MOST_TURNS} + t.turn AS id, t.conv_id * {MOST_TURNS} + c.root AS conversation,
  t.conv_id * {MOST_TURNS} + r.parent AS reply_to, CAST(c.depth AS BIGINT) AS depth,
  row_number() OVER (PARTITION BY t.conv_id, c.root ORDER BY t.turn) - 1 AS turn, t.role AS role,
  sha256(trim(t.text, chr(10))) AS text_sha256
FROM turns t JOIN chain c USING (conv_id, turn) LEFT JOIN replies r USING (conv_id, turn)
"""


def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equally labelled vectors linked by a cosine of at least 0.93."""
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with faults chosen by a hash of conversation and turn; nulls read as one space.

    Of twenty: 0 drops the row, 1 empties its text, 2 removes its sentence
    ends, 3 repeats it, 4 makes it a user's.
    """
    def read(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    case = F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", read("role").alias("role"), read("text").alias("text"), case.alias("case")).filter("case <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired: its faults, the cheapest edits and the result's digest."""
    source = table(spark, sf_dir, "conversations")
    fixed = turn_repair.repair(damaged(source))
    pieces = fixed.edits.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "edits"))).alias("p"))
    audits = pieces.select("conv_id", F.array_join(F.transform("p", lambda x: x["edits"]), "").alias("audit"))
    out = source.select("conv_id").distinct()
    for part in (fixed.report, audits, turn_repair.conversation_digests(fixed.turns)):
        named = part.withColumnRenamed("conv_id", "other")
        out = out.join(named, F.col("conv_id").eqNullSafe(F.col("other")), "left").drop("other")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_decontaminate": op2_decontaminate,
        "op3_token_binary": op3_token_binary,
        "op4_language_id": op4_language_id,
        "op5_near_dedup": op5_near_dedup,
        "op6_sharding": op6_sharding,
        "op7_suffix_array_dedup": op7_suffix_array_dedup,
        "op8_fingerprints": op8_fingerprints,
        "op9_bpe": op9_bpe,
        "op10_quote_links": op10_quote_links,
        "op11_vector_dedup": op11_vector_dedup,
        "op12_turn_repair": op12_turn_repair,
        "op13_ranked_search": op13_ranked_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.SQL, "op10_quote_links": OP10_SQL, "op13_ranked_search": ranked_search.SQL}
