"""Document fingerprints by a threshold-scaled sketch (operator 8), in DataFrame functions alone.

A sketch keeps every 5-word shingle hash below a fixed fraction of the hash
range, and at least the LEAST smallest ones: a text with fewer shingles keeps
them all, so only a text without words has an empty sketch. How far a sketch
is complete shows in the sketch itself, and two are compared as far as both
are. Sketches of parts merge, and as the fraction is the same for all
documents, the containment of a short document in a very long one can be
estimated from their sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ordered_ids

#: The kept share of all shingle hashes is 1 / SCALE.
SCALE = 4
#: A sketch has at least so many hashes, or all.
LEAST = 32
#: Hashes have so many bits: they fit an int.
BITS = 31
WIDTH = 5
_WORD = r"[\x20\x09-\x0D]+"


def sketch(text: Column, scale: int = SCALE, width: int = WIDTH) -> Column:
    """Sorted distinct kept hashes (array<int>) of a text's word shingles.

    Words are runs of characters other than \\x20 and \\x09-\\x0D, A-Z
    lower-cased. Fewer than `width` words: the whole sequence is one shingle.
    No words, or null: an empty sketch.
    """
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(F.coalesce(lowered, F.lit("")), _WORD), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(h) - (width - 1), F.lit(1)))
        return F.transform(at, lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(h, i, F.lit(width))), 64 - BITS).cast("int"))

    # the lambda binds the word hashes once: they are not computed again for each position
    kept = F.flatten(F.transform(F.transform(F.array(hashes), shingles), lambda every: _smallest(every, scale)))
    return F.when(F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")) == "",
                  F.array().cast("array<int>")).otherwise(kept)


def _smallest(every: Column, scale: int) -> Column:
    """The sorted distinct hashes below the fraction, or the LEAST smallest where fewer are."""
    low = F.array_sort(F.array_distinct(F.filter(every, lambda h: h < (1 << BITS) // scale)))
    # the lambda binds the low hashes once
    return F.flatten(F.transform(F.array(low), lambda low: F.when(F.size(low) >= LEAST, low).otherwise(
        F.slice(F.array_sort(F.array_distinct(every)), 1, LEAST))))


def _reach(a: Column, scale: int) -> Column:
    """The hash up to which a sketch has all of its text's: fewer than LEAST are all there are."""
    return F.when(F.size(a) < LEAST, F.lit((1 << BITS) - 1)).otherwise(F.greatest(F.lit((1 << BITS) // scale - 1), F.element_at(a, -1)))


def _common(a: Column, b: Column, scale: int) -> tuple[Column, Column]:
    """Both sketches as far as both are complete."""
    reach = F.array(F.least(_reach(a, scale), _reach(b, scale)))  # bound by a lambda: not computed again for each hash

    def cut(x: Column) -> Column:
        return F.flatten(F.transform(reach, lambda r: F.filter(x, lambda h: h <= r)))

    return cut(a), cut(b)


def merge_sketches(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of two texts' shingles together."""
    return _smallest(F.array_union(*_common(a, b, scale)), scale)


def likeness(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Estimated Jaccard similarity, exact for sketches of fewer than LEAST hashes; two empty sketches
    are alike (1), an empty and another are not (0)."""
    a, b = _common(a, b, scale)
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty `a`, null where none of a's hashes can be compared."""
    own, other = _common(a, b, scale)
    return F.when(F.size(a) == 0, F.lit(1.0)).when(F.size(own) > 0, F.size(F.array_intersect(own, other)) / F.size(own))


def as_text(hashes: Column) -> Column:
    """A sketch as a string: eight hex digits for each hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))), "")


def fingerprint_with_next(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Each document's sketch beside that of its edited text and of the next document.

    The edited text: the last floor(n_chars / 4) code points are replaced by
    the first as many (or all) of the next document in ascending doc_id;
    after the last comes the first. Null text reads as empty. Null doc_ids
    sort first and, like any repeated doc_id, count as one document here: the
    text that sorts first stands for them as someone's next document, and
    each row has its own result.

    Columns: doc_id, n_chars, edited, sketch, edited_sketch, next_sketch.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = texts.select("doc_id", F.char_length("text").cast("long").alias("n_chars"))
    ids = ordered_ids(own, "doc_id")
    quarter = own.groupBy("doc_id").agg(F.floor(F.max("n_chars") / 4).alias("quarter"))
    known = ids.join(quarter, ids["doc_id"].eqNullSafe(quarter["doc_id"])).select(ids["doc_id"].alias("prev_id"), "idx", "quarter")
    last = ids.agg(F.max("idx")).first()[0]  # one number: after the last document comes the first
    links = (known.select("prev_id", "quarter", F.when(F.col("idx") == F.lit(last), F.lit(0)).otherwise(F.col("idx") + 1).alias("idx"))
             .join(ids, "idx").select("prev_id", "quarter", F.col("doc_id").alias("next_id")))

    sketched = texts.withColumn("sketch", sketch(F.col("text"), scale))
    heads = (sketched.join(links, sketched["doc_id"].eqNullSafe(links["next_id"]))
             .select("prev_id", F.expr("substring(text, 1, cast(quarter as int))").alias("head"), F.col("sketch").alias("next_sketch"))
             .groupBy("prev_id").agg(F.min(F.struct("head", "next_sketch")).alias("n")))
    joined = (sketched.join(heads, sketched["doc_id"].eqNullSafe(heads["prev_id"]))
              .withColumn("n_chars", F.char_length("text").cast("long")))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    kept = (F.col("n_chars") - cut).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), kept), F.substring(F.col("n.head"), F.lit(1), cut))
    return (joined.select("doc_id", "n_chars", "sketch", F.col("n.next_sketch").alias("next_sketch"), edited.alias("edited"))
            .withColumn("edited_sketch", sketch(F.col("edited"), scale)))
