"""Removal of lines that recur across documents, in DataFrame functions only.

Every text is exploded into its lines.  A line's key is the line without white space at its ends (space, tab, line feed,
vertical tab, form feed, return) and with A-Z lower-cased; keys of at least ``min_chars`` code points count, each by two
64-bit hashes.  A key found in at least ``min_docs`` documents loses all its lines but those in the largest document id
that holds it.  The other lines keep their order and are joined again.

How it runs: a line travels as two hashes and its document's id, never as text.  The lines are first reduced to one row
per key and document, then to one row per key; both steps add up before the shuffle, so a line that a third of all documents
hold is no hot spot.  The keys over the threshold are stored and meet the lines once more, broadcast if their counted
number is small and else by a join of two plain exchanges, which Spark splits where a key is hot.  What comes back to a text is
the set of its dropped positions, never more than the lines of that one text.

Null and empty texts are one empty line, which is too short to be dropped.  A document is an id: rows that share an id count
as one document, and a null id is one document below all others.  Equal rows get equal results, each of them.  Other
columns stay; a column called like a new one is replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.llm.common import save_table, table

MIN_CHARS, MIN_DOCS = 20, 3
#: frequent lines (24 bytes each) are broadcast up to this number
BROADCAST_KEYS = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), _UPPER, _LOWER)


def two_hashes(*cols: Column) -> list[Column]:
    return [F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)]


def lines_of(rows: DataFrame, min_chars: int) -> DataFrame:
    """``id``, ``t1``, ``t2`` (hashes of the row's id and text), ``at`` and the key's hashes ``h1``, ``h2`` of each long enough line."""
    lines = rows.select("id", "t1", "t2", F.posexplode(F.split("text", "\n", -1)).alias("at", "line")).withColumn("key", line_key(F.col("line")))
    h1, h2 = two_hashes(F.col("key"))
    return lines.filter(F.length("key") >= min_chars).select("id", "t1", "t2", "at", h1.alias("h1"), h2.alias("h2"))


def frequent_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """``h1``, ``h2``, ``last`` (largest id) and ``n_docs`` of every key in at least ``min_docs`` documents."""
    seen = lines.select("h1", "h2", "id").distinct()
    found = seen.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("last"))
    return found.filter(F.col("n_docs") >= min_docs)


def small(df: DataFrame, limit: int) -> DataFrame:
    """``df``, a stored table, marked for a broadcast if its counted rows are at most ``limit``."""
    return F.broadcast(df) if df.count() <= limit else df


def drop_frequent_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                        broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """The rows of ``df``, ``text_col`` without its dropped lines, with ``n_lines`` (before dropping) and ``n_dropped``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ident = F.col(f"`{id_col}`")
    t1, t2 = two_hashes(ident, text)
    rows = df.select(ident.alias("id"), text.alias("text"), t1.alias("t1"), t2.alias("t2"))
    lines = lines_of(rows, min_chars)
    keys = save_table(frequent_lines(lines, min_docs), "frequent-lines")
    gone = lines.join(small(keys, broadcast_keys), ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("last")))
    gone = save_table(gone.groupBy("t1", "t2").agg(F.collect_set("at").alias("gone")), "dropped-lines")

    kept_columns = [c for c in df.columns if c.lower() not in ("n_lines", "n_dropped")]
    # the row travels as one struct, so that no column of it can clash with the names here
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("row"), text.alias("text"), t1.alias("t1"), t2.alias("t2"))
    whole = whole.join(gone, ["t1", "t2"], "left").withColumn("lines", F.split("text", "\n", -1))
    positions = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    left = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(positions, lambda p: F.get(F.col("lines"), p)), "\n"))
    return whole.select(*[left.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in kept_columns],
                        F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = rf"""
WITH lines AS (SELECT r, doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS nth
    FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS k FROM lines),
often AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (SELECT keyed.*, often.k IS NOT NULL AND keyed.doc_id IS DISTINCT FROM often.last AS gone FROM keyed LEFT JOIN often ON often.k = keyed.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""
