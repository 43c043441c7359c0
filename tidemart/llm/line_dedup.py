"""Line dedup by a log-template tree (operator 1), in DataFrame functions alone.

Lines fall into leaves of a tree of fixed depth: token count, then the leading
tokens (a token with a digit counts as variable). In a leaf, a token that
a share of the leaf's lines has at its position is constant and any other is a
variable field, so the values of a field stay variable however large the leaf
grows; the constants at their positions are the line's template. Lines whose
template recurs across documents are boilerplate and are dropped, and so are
lines that recur as they are, whatever their tokens.

Documents are counted by distinct text, so exact copies do not make a line
recurrent. A document of which more than MAX_DROPPED would go has next to
nothing of its own: near copies of each other (0.8 of their shingles alike)
look like that, so it is left whole for near-dedup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused, written

#: Leading tokens that name a leaf, below the token count.
DEPTH = 3
#: Distinct documents across which a leaf, a template or a line recurs.
MIN_DOCS = 10
#: Least share of a leaf's lines (one for each document that has it), and least number, that make a token constant.
CONSTANT_SHARE, CONSTANT_LINES = 0.1, 2
#: Least share of constant tokens in a template.
MIN_CONSTANT = 0.6
#: A document keeps all its lines where more than this share of its bytes would go.
MAX_DROPPED = 0.8


def _leaf(line: Column) -> Column:
    tokens = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return F.xxhash64(tokens, F.regexp_replace(F.substring_index(line, " ", DEPTH), r"[^ ]*[0-9][^ ]*", "<*>"))


def recurring_lines(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, lines): by the hash of a document's text, the hashes of its lines with a recurring template.

    Only documents with such lines have a row. Blank lines have no template.
    """
    lines = (docs.filter(F.col(text).isNotNull())
             .select(F.xxhash64(text).alias("doc"), F.explode(F.array_distinct(F.split(text, "\n"))).alias("line"))
             .filter(F.trim("line") != "").withColumn("leaf", _leaf(F.col("line"))))
    leaves = (lines.select("leaf", "doc").distinct().groupBy("leaf").agg(F.count("*").alias("n"))
              .filter(F.col("n") >= min_docs).select("leaf"))
    # written before it is grouped: the join alone can be split where a leaf is hot
    found = written(lines.join(leaves, "leaf", "left_semi").withColumn("id", F.xxhash64("line")), "recurring-leaves")
    placed = found.groupBy("leaf", "id", "doc").agg(F.first("line").alias("line"))

    distinct = placed.groupBy("leaf", "id").agg(F.first("line").alias("line"), F.count("*").alias("n"))
    tokens = distinct.select("leaf", "id", "n", F.posexplode(F.split("line", " ")).alias("pos", "token"))
    variable = F.col("token").rlike("[0-9]")
    sizes = distinct.groupBy("leaf").agg(F.sum("n").alias("lines"))
    constant = (tokens.filter(~variable).groupBy("leaf", "pos", "token").agg(F.sum("n").alias("docs"))
                .filter(F.col("docs") >= CONSTANT_LINES).join(sizes, "leaf").filter(F.col("docs") >= CONSTANT_SHARE * F.col("lines"))
                .select("leaf", "pos", "token", F.lit(True).alias("constant")))
    fields = F.array_sort(F.collect_list(F.when(F.col("constant"), F.struct("pos", "token"))))
    templates = (tokens.join(constant, ["leaf", "pos", "token"], "left")
                 .groupBy("leaf", "id").agg(fields.alias("fields"), F.count("*").alias("n"))
                 .filter(F.size("fields") >= MIN_CONSTANT * F.col("n"))
                 .select("leaf", "id", F.xxhash64("leaf", "fields").alias("template")))
    seen = written(placed.select("leaf", "id", "doc").join(templates, ["leaf", "id"]).select("template", "doc", "id"), "templates")
    recurring = (seen.select("template", "doc").distinct().groupBy("template").agg(F.count("*").alias("n"))
                 .filter(F.col("n") >= min_docs).select("template"))
    as_is = distinct.filter(F.col("n") >= min_docs).select("leaf", "id")
    gone = seen.join(recurring, "template").select("doc", "id").unionByName(placed.join(as_is, ["leaf", "id"], "left_semi").select("doc", "id"))
    return gone.groupBy("doc").agg(F.collect_set("id").alias("lines"))


def drop_recurring_lines(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """`docs` with recurring lines taken out of the text, plus `n_lines` and `n_dropped`.

    All rows and columns stay (columns named n_lines or n_dropped are
    replaced). Lines end at \\n. Null text stays null with 0 lines; an empty
    text has one line and stays. Every occurrence of a recurring line goes,
    repeats inside a document too. An empty table gives an empty table.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    key, doc, lines, every, kept = unused(docs, "_key", "_doc", "_lines", "_all", "_kept")
    marked = recurring_lines(docs.select(text), text, min_docs).select(F.col("doc").alias(doc), F.col("lines").alias(lines))
    joined = (docs.select(*keep, F.xxhash64(text).alias(key)).join(marked, F.col(key) == F.col(doc), "left")
              .withColumn(every, F.split(text, "\n"))
              .withColumn(kept, F.filter(every, lambda line: ~F.array_contains(F.col(lines), F.xxhash64(line)))))
    cut = F.array_join(kept, "\n")
    boilerplate = F.col(lines).isNotNull() & (F.octet_length(cut) >= round(1 - MAX_DROPPED, 6) * F.octet_length(text))
    return joined.select(
        *(F.when(boilerplate, cut).otherwise(F.col(text)).alias(text) if c == text else F.col(c) for c in keep),
        F.coalesce(F.size(every), F.lit(0)).alias("n_lines"),
        F.when(boilerplate, F.size(every) - F.size(kept)).otherwise(F.lit(0)).alias("n_dropped"))


#: The same rules as SQL over the `documents` view.
SQL = f"""
WITH lines AS (
  SELECT DISTINCT text AS doc, line, len(string_split(line, ' ')) AS n_tokens,
    regexp_replace(array_to_string(list_slice(string_split(line, ' '), 1, {DEPTH}), ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS lead
  FROM (SELECT text, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL)
  WHERE trim(line) <> ''),
leaves AS (SELECT n_tokens, lead FROM lines GROUP BY ALL HAVING count(DISTINCT doc) >= {MIN_DOCS}),
placed AS (SELECT * FROM lines SEMI JOIN leaves USING (n_tokens, lead)),
own AS (SELECT n_tokens, lead, line, count(*) AS n FROM placed GROUP BY ALL),
tokens AS (
  SELECT n_tokens, lead, line, n, unnest(string_split(line, ' ')) AS token, generate_subscripts(string_split(line, ' '), 1) AS pos FROM own),
sizes AS (SELECT n_tokens, lead, sum(n) AS n_lines FROM own GROUP BY ALL),
constant AS (
  SELECT n_tokens, lead, pos, token FROM tokens JOIN sizes USING (n_tokens, lead) WHERE NOT regexp_matches(token, '[0-9]')
  GROUP BY n_tokens, lead, pos, token, n_lines HAVING sum(n) >= {CONSTANT_LINES} AND sum(n) >= {CONSTANT_SHARE} * n_lines),
templates AS (
  SELECT n_tokens, lead, line, list({{'pos': pos, 'token': c.token}} ORDER BY pos) FILTER (c.token IS NOT NULL) AS fields
  FROM tokens t LEFT JOIN constant c USING (n_tokens, lead, pos, token)
  GROUP BY ALL HAVING count(c.token) >= {MIN_CONSTANT} * count(*)),
recurring AS (
  SELECT n_tokens, lead, fields FROM placed JOIN templates USING (n_tokens, lead, line)
  GROUP BY ALL HAVING count(DISTINCT doc) >= {MIN_DOCS}),
dropped AS (
  SELECT line FROM templates SEMI JOIN recurring USING (n_tokens, lead, fields) UNION SELECT line FROM own WHERE n >= {MIN_DOCS}),
every AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
cut AS (
  SELECT doc_id, text, count(*) AS n_lines, count(d.line) AS hit,
    coalesce(string_agg(e.line, chr(10) ORDER BY pos) FILTER (d.line IS NULL), '') AS kept
  FROM every e LEFT JOIN dropped d ON e.line = d.line GROUP BY doc_id, text)
SELECT doc_id, CAST(n_lines AS INTEGER) AS n_lines,
  CAST(CASE WHEN strlen(kept) >= {round(1 - MAX_DROPPED, 6)} * strlen(text) THEN hit ELSE 0 END AS INTEGER) AS n_dropped,
  sha256(CASE WHEN strlen(kept) >= {round(1 - MAX_DROPPED, 6)} * strlen(text) THEN kept ELSE text END) AS kept_sha256
FROM cut
"""
