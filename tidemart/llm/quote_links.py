"""Chat formatting by quotation linking (operator 10).

Messages quote what they answer: lines behind one or more `>`. A message is
parsed into its own paragraphs (level 0) and the quoted ones with their
levels; paragraphs are normalised and hashed, quoted hashes are joined with
the own paragraphs of other messages, and each message replies to the one it
quotes most at its lowest linked level. Chains of replies make conversations,
in reply order and without the quotes.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, written

_MARKS = re.compile(r"(?:[ \t]*>)+")
_ATTRIBUTION = re.compile(r"^\S.{0,200}\bwrote:\s*$")


def parse_quotes(text: str) -> list[tuple[int, list[str]]]:
    """A message's paragraphs in order: (quote level, lines without their marks).

    A paragraph ends at a blank line or where the level changes.
    """
    out: list[tuple[int, list[str]]] = []
    open_ = False
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        level = marks.group().count(">") if marks else 0
        line = line[marks.end():].strip() if marks else line
        if not line.strip():
            open_ = False
            continue
        if not open_ or out[-1][0] != level:
            out.append((level, []))
        out[-1][1].append(line)
        open_ = True
    return out


def passage_hash(lines: list[str]) -> int:
    """64 bits of the paragraph, lower-cased, with every run of white space as one blank."""
    flat = " ".join(" ".join(lines).lower().split())
    return int.from_bytes(hashlib.blake2b(flat.encode(), digest_size=8).digest(), "little", signed=True)


def own_text(text: str) -> str:
    """The message without quoted lines and without the attribution line before a quote."""
    lines, kept = text.split("\n"), []
    for i, line in enumerate(lines):
        if _MARKS.match(line):
            continue
        if _ATTRIBUTION.match(line) and i + 1 < len(lines) and _MARKS.match(lines[i + 1]):
            continue
        kept.append(line)
    return "\n".join(kept).strip("\n")


def _parsed(messages: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(3).to_pylist()]
            own, mine, quoted = [], [], []
            for t in texts:
                body = own_text(t)
                own.append(body)
                mine.append(sorted({passage_hash(lines) for level, lines in parse_quotes(body)}))
                quoted.append([{"level": level, "hash": passage_hash(lines)} for level, lines in parse_quotes(t) if level])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], batch.column(4), pa.array(own, pa.string()), pa.array(mine, pa.list_(pa.int64())),
                 pa.array(quoted, pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64())])))],
                ["id", "scope", "at", "role", "own", "mine", "quoted"])

    return messages.mapInArrow(run, "id long, scope long, at long, role string, own string, mine array<long>, "
                                    "quoted array<struct<level:int,hash:long>>")


def _roots(replies: DataFrame) -> DataFrame:
    """(id, root, depth) of every message that replies to another.

    Each round doubles the reach of the messages that are not at their root
    yet; the others are done and not joined again.
    """
    answering = replies.select(F.col("id").alias("root"), F.lit(True).alias("more"))
    reach = saved(replies.select("id", F.col("parent").alias("root"), F.lit(1).alias("depth"))
                  .join(answering, "root", "left").select("id", "root", "depth", F.coalesce("more", F.lit(False)).alias("more")))
    done, going = reach.filter("NOT more"), reach.filter("more")
    while going.limit(1).count():
        up = done.unionByName(going).select(F.col("id").alias("root"), F.col("root").alias("_root"), F.col("depth").alias("_depth"), F.col("more").alias("_more"))
        reach = saved(going.join(up, "root").select(
            "id", F.col("_root").alias("root"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_more").alias("more")))
        done, going = done.unionByName(reach.filter("NOT more")), reach.filter("more")
    return done.drop("more")


def _turns(rows: DataFrame) -> DataFrame:
    """Adds `turn`: 0, 1, ... in each conversation by time, then id.

    Rows are range-partitioned and numbered where they lie. Only conversations
    that cross a partition's edge need a shift: at most two for each partition.
    """
    order = ["conversation", "at", "id"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    schema = ranged.withColumn("_local", F.lit(0).cast("long")).schema

    def number(batches):
        last, n = object(), 0
        for batch in batches:
            local = []
            for c in batch.column(batch.schema.names.index("conversation")).to_pylist():
                n = n + 1 if c == last else 0
                last = c
                local.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())], [*batch.schema.names, "_local"])

    numbered = written(ranged.mapInArrow(number, schema), "chat-turns")
    parts = numbered.groupBy("conversation", "_part").agg(F.count("*").alias("_n"))
    crossing = parts.groupBy("conversation").agg(F.count("*").alias("k")).filter("k > 1").select("conversation")
    before = Window.partitionBy("conversation").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (parts.join(crossing, "conversation", "left_semi")
             .select("conversation", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (numbered.join(F.broadcast(shift), ["conversation", "_part"], "left")
            .withColumn("turn", F.coalesce("_before", F.lit(0)) + F.col("_local")).drop("_part", "_local", "_before"))


def link_quotes(messages: DataFrame, id: str = "id", at: str = "at", text: str = "text", role: str = "role",
                scope: str | None = None) -> DataFrame:
    """Conversations rebuilt from quotations: one row per message.

    Columns: id, conversation (id of the message it began with), reply_to
    (null for the first), depth (replies above it), turn (0, 1, ... by time in
    its conversation), role, text (without quotes and attribution lines) and
    formatted (`<|role|>` line, text, newline).

    A quotation means the earliest message (by `at`, then id) of the same
    `scope` with that paragraph of its own, if that one is earlier than the
    quoting message. Of several, the lowest quote level decides, then the
    number of quoted paragraphs, then the later message. Messages without a
    linked quotation begin a conversation; null or empty texts link with
    nothing and have empty text. Rows that repeat an id are one message, that
    with the smallest text. Rows with a null id or time are left out: nothing
    can name or order them. A null scope is a scope of its own. An empty table
    gives no rows.
    """
    chosen = messages.select(
        F.col(id).cast("long").alias("id"), (F.col(scope).cast("long") if scope else F.lit(0).cast("long")).alias("scope"),
        F.col(at).cast("long").alias("at"), F.col(text).alias("text"), F.col(role).alias("role"))
    single = (chosen.filter("id IS NOT NULL AND at IS NOT NULL").groupBy("id")
              .agg(F.min(F.struct("text", "scope", "at", "role")).alias("m")).select("id", "m.scope", "m.at", "m.text", "m.role"))
    parsed = written(_parsed(single), "messages")
    key = F.coalesce("scope", F.lit(-(1 << 63)))
    first = (parsed.select(key.alias("scope"), F.explode("mine").alias("hash"), F.struct("at", "id").alias("o"))
             .groupBy("scope", "hash").agg(F.min("o").alias("o")))
    quotes = parsed.select("id", "at", key.alias("scope"), F.explode("quoted").alias("q")).select("id", "at", "scope", "q.level", "q.hash")
    earlier = (F.col("o.at") < F.col("at")) | ((F.col("o.at") == F.col("at")) & (F.col("o.id") < F.col("id")))
    links = quotes.join(first, ["scope", "hash"]).filter(earlier)
    counted = links.groupBy("id", "level", "o").agg(F.count("*").alias("n"))
    replies = saved(counted.groupBy("id").agg(F.max(F.struct((-F.col("level")).alias("level"), "n", "o")).alias("b"))
                    .select("id", F.col("b.o.id").alias("parent")))
    placed = (parsed.join(_roots(replies), "id", "left").join(replies, "id", "left")
              .select("id", F.coalesce("root", "id").alias("conversation"), F.col("parent").alias("reply_to"),
                      F.coalesce("depth", F.lit(0)).alias("depth"), "at", "role", F.col("own").alias("text")))
    return _turns(placed).select(
        "id", "conversation", "reply_to", "depth", "turn", "role", "text",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "text", F.lit("\n")).alias("formatted"))
