"""Source divergence audit: how far the term frequencies of sources of one language lie apart.

Every language keeps the terms that enough of its documents hold.  A group (a source of a language) gives each kept term the
smoothed share p = 1 + floor(10^9 (count + 5) / (N + 5 V)); so does the language as a whole.  Two sources differ by the
sum of abs(p - q) over all kept terms; a source's own terms are those with p above the language's.

The pair sums come from a frequent-pattern tree.  A kept term is a row: its sources with a count, in source order, each as
(source, p).  With z the share of a count of zero, the sum over all terms splits into

    V abs(z_s - z_t)
    + over the terms of s:  abs(p_s - z_t) - abs(z_s - z_t)          and the same for t
    + over common terms:    abs(p_s - p_t) - abs(p_s - z_t) - abs(p_t - z_s) + abs(z_s - z_t)

The last line is the pair correction, and the tree adds it up.  Equal rows are counted into one with a multiplicity, the rows
are dealt out by range and sorted, and in each task consecutive rows share the path of their common prefix: a
tree node is one (source, p) below one prefix, its multiplicity the terms that pass through it.  Each node meets each of its
ancestors once, weighted by that multiplicity, in steps of one generation for all nodes of a batch at a time.  A node that a batch or task
boundary cuts in two is counted in two parts, which add up to the same.  The middle lines need no pairs of terms: per
source, running sums over its distinct p in order answer every z_t.

Bounds: a task holds at most ``FLUSH_TERMS`` counted terms and one more text's, ``TREE_ITEMS`` items of the tree or one longer row, and
``TREE_PAIRS`` pairs and one more generation.  A term's row, and a source's list of others, are no longer than the language has sources, of which
the result holds all pairs; a source has at most sqrt(2 N) different counts.  Frequent terms and hot sources are added up in
the tasks before the shuffle.  All sums are whole numbers.

Null text, language and source count as ''.  Repeated rows count repeatedly.  A language without kept terms gives pairs with value 0
and no terms.  Equal values are ranked by the item's UTF-8 bytes.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimwright.llm.common import SLICE_ROWS, let_workers_import, save_table, table
from dimwright.llm.line_dedup import small

MIN_DOCS, SMOOTHING, SCALE, TOP_TERMS = 30, 5, 1_000_000_000, 50
#: distinct terms counted in a task before they are handed on; items of the tree, and pairs met in it, held at a time
FLUSH_TERMS, TREE_ITEMS, TREE_PAIRS = 300_000, 100_000, 1_000_000
#: groups (sources of languages) are broadcast up to this number
BROADCAST_GROUPS = 100_000

WHOLE = "decimal(38,0)"
#: bytes: A-Z to a-z, other ASCII than letters to space, the rest unchanged
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def count_terms(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``df`` (documents) from rows of (lang, source, text)."""

    def run(batches: Iterator):
        from collections import Counter

        import pyarrow as pa

        def batch(held: dict):
            langs, sources, terms, ns, dfs = [], [], [], [], []
            for (lang, source), (n, df) in held.items():
                langs += [lang] * len(n)
                sources += [source] * len(n)
                terms += n
                ns += n.values()
                dfs += map(df.__getitem__, n)
            terms = pa.array(terms, pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(sources, pa.string()), terms,
                                               pa.array(ns, pa.int64()), pa.array(dfs, pa.int64())], names=["lang", "source", "term", "n", "df"])

        held, size = {}, 0
        for b in (whole.slice(i, SLICE_ROWS) for whole in batches for i in range(0, whole.num_rows, SLICE_ROWS)):
            for lang, source, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                n, df = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                terms = text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()
                n.update(terms)
                df.update(set(terms))
                size += len(n)
                if size > FLUSH_TERMS:
                    yield batch(held)
                    held, size = {}, 0
        if held:
            yield batch(held)

    let_workers_import(docs.sparkSession)
    parts = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, df long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: Column | str, total: str, terms: str) -> Column:
    """1 + floor(SCALE (count + SMOOTHING) / (total + SMOOTHING terms)), exact; null without terms."""
    count = F.col(count) if isinstance(count, str) else count
    top = ((count + SMOOTHING).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")).cast(WHOLE)
    low = (F.col(total) + F.lit(SMOOTHING) * F.col(terms)).cast(WHOLE)
    return F.when(F.col(terms) > 0, F.lit(1) + F.call_function("div", top, low)).cast("long")


def kept_rows(counts: DataFrame, min_docs: int) -> DataFrame:
    """A row per language and kept term: ``n_lang`` and ``items``, its (source, n)."""
    rows = counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("n_lang"),
                                              F.collect_list(F.struct("source", "n")).alias("items"))
    return rows.filter(F.col("df") >= min_docs).drop("df")


def group_shares(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``place`` (order of the sources in a language), ``total`` (N), ``terms`` (V), ``lang_total`` and ``zero``
    (the share of a count of zero) of each group."""
    totals = (rows.select("lang", F.explode("items").alias("i")).groupBy("lang", F.col("i.source").alias("source"))
              .agg(F.sum("i.n").alias("total")))
    langs = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n_lang").alias("lang_total"))
    out = groups.join(totals, ["lang", "source"], "left").join(langs, ["lang"], "left").fillna(0, ["total", "terms", "lang_total"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return out.withColumn("place", place.cast("long")).withColumn("zero", share(F.lit(0), "total", "terms"))


def tree_corrections(paths: DataFrame) -> DataFrame:
    """``lang``, ``s``, ``t`` and ``value``: the pair corrections of the tree over rows of (lang, path, many).

    ``path`` is a list of (place, p, zero) in the order of ``place``; ``many`` the number of terms with it.  Rows come sorted."""

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute

        def tree(codes, many, size, item):
            """Nodes of consecutive sorted rows: (place, p, zero) and multiplicity of each, its parent and its language."""
            n, start = len(size), np.cumsum(size) - size
            row = np.repeat(np.arange(n), size)
            depth = np.arange(len(row)) - start[row]
            # an item is shared with the row before if that row is long enough and agrees so far
            before = np.where(row > 0, start[row - 1] + depth, 0)
            same = (row > 0) & (depth < size[row - 1]) & (codes[row] == codes[row - 1])
            same &= (item[:, before] == item).all(axis=0)
            # the first place of a row that differs; everything from there on is new
            differs = np.where(same, np.iinfo(np.int64).max, depth)
            first = np.minimum.reduceat(differs, start)
            new = depth >= first[row]
            # node of each item: the last new item at its depth; a shared item takes the node above it
            node = np.cumsum(new) - 1
            by_depth = np.argsort(depth, kind="stable")
            made = np.where(new, node, -1)[by_depth] + depth[by_depth] * len(row)
            node[by_depth] = np.maximum.accumulate(made) - depth[by_depth] * len(row)
            weight = np.zeros(int(new.sum()), np.int64)
            np.add.at(weight, node, many[row])
            parent = np.where(depth[new] > 0, node[np.flatnonzero(new) - 1], -1)
            return item[:, new], weight, parent, codes[row][new]

        def added_up(names, keys, values):
            keys, values = np.concatenate(keys, axis=1), np.concatenate(values)
            order = np.lexsort(keys[::-1])
            keys, values = keys[:, order], values[order]
            head = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            return pa.RecordBatch.from_arrays([pa.array(names[keys[0, head]], pa.string()), pa.array(keys[1, head]), pa.array(keys[2, head]),
                                               pa.array(np.add.reduceat(values, head))], names=["lang", "s", "t", "value"])

        def sums(langs, many, size, item):
            names, codes = np.unique(np.array(langs, dtype=object), return_inverse=True)
            (place, p, zero), weight, parent, lang = tree(codes, many, size, item)
            node, above, held = np.arange(len(parent)), parent, 0
            keys, values = [], []
            while (alive := above >= 0).any():  # the next generation up, for all nodes that have one
                node, above = node[alive], above[alive]
                value = (np.abs(p[above] - p[node]) - np.abs(p[above] - zero[node]) - np.abs(p[node] - zero[above])
                         + np.abs(zero[above] - zero[node]))
                keys.append(np.stack([lang[node], place[above], place[node]]))
                values.append(value * weight[node])
                held += len(node)
                if held > TREE_PAIRS:
                    yield added_up(names, keys, values)
                    keys, values, held = [], [], 0
                above = parent[above]
            if held:
                yield added_up(names, keys, values)

        length = lambda lists: pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        for whole in batches:
            start = 0
            while start < whole.num_rows:
                ends = np.cumsum(length(whole.column(1).slice(start)))
                rows = max(1, int(np.searchsorted(ends, TREE_ITEMS, "right")))
                b = whole.slice(start, rows)
                flat = b.column(1).flatten()
                item = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in range(3)])
                yield from sums(b.column(0).to_pylist(), b.column(2).to_numpy(zero_copy_only=False), length(b.column(1)), item)
                start += rows

    let_workers_import(paths.sparkSession)
    return (paths.select("lang", "path", "many").mapInArrow(run, "lang string, s long, t long, value long")
            .groupBy("lang", "s", "t").agg(F.sum(F.col("value").cast(WHOLE)).alias("value")))


def single_sums(groups: DataFrame, values: DataFrame) -> DataFrame:
    """``lang``, ``s``, ``t``, ``value``: over the terms of s, the sum of abs(p - z_t) - abs(z_s - z_t).

    ``values`` holds each group's distinct ``p`` with their number ``many``."""
    one = groups.select("lang", F.col("place").alias("s"), F.col("zero").alias("own"))
    other = groups.select("lang", F.col("place").alias("t"), F.col("zero").alias("x"))
    asked = one.join(other, "lang").filter("s != t").select("lang", "s", "t", "x", "own", F.lit(0).cast("long").alias("many"))
    known = values.select("lang", F.col("place").alias("s"), F.lit(None).cast("long").alias("t"), F.col("p").alias("x"),
                          F.lit(None).cast("long").alias("own"), "many")
    group = Window.partitionBy("lang", "s")
    upto = group.orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    mass = (F.col("x") * F.col("many")).cast(WHOLE)
    n, below = F.col("__n"), F.col("__n_below")
    total = F.col("x") * (below * 2 - n) + F.col("__mass") - F.col("__mass_below") * 2
    out = asked.unionByName(known).withColumns({
        "__n": F.sum("many").over(group).cast(WHOLE), "__mass": F.sum(mass).over(group).cast(WHOLE),
        "__n_below": F.sum("many").over(upto).cast(WHOLE), "__mass_below": F.sum(mass).over(upto).cast(WHOLE)})
    return out.filter("t is not null").select("lang", "s", "t", (total - n * F.abs(F.col("own") - F.col("x"))).cast(WHOLE).alias("value"))


def audit_sources(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS,
                  top: int = TOP_TERMS) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value``, ``rank``: every source's divergence from each other source of
    its language, and the ``top`` terms that it holds above its language's share."""
    docs = df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    rows = save_table(kept_rows(count_terms(docs), min_docs), "kept-terms")
    groups = save_table(group_shares(docs.select("lang", "source").distinct(), rows), "group-shares")
    shares = small(groups, BROADCAST_GROUPS)
    items = rows.select("lang", "term", "n_lang", F.explode("items").alias("i")).select("lang", "term", "n_lang", "i.source", "i.n")
    items = items.join(shares, ["lang", "source"])
    items = items.withColumns({"p": share("n", "total", "terms"), "q": share("n_lang", "lang_total", "terms")})

    # the terms of a source above the language's share
    own = items.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = own.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)

    # the sources of a language against each other
    path = F.array_sort(F.collect_list(F.struct("place", "p", "zero")))
    paths = items.groupBy("lang", "term").agg(path.alias("path")).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("many"))
    paths = save_table(paths, "term-rows")
    # dealt out by the first items, then by a hash: the bounds of the ranges are found from few bytes a row
    near = paths.repartitionByRange("lang", F.slice("path", 1, 2), F.xxhash64("path"))
    common = tree_corrections(near.sortWithinPartitions("lang", "path"))
    values = items.groupBy("lang", "place", "p").agg(F.count(F.lit(1)).alias("many"))
    single = single_sums(groups.filter("terms > 0"), values)
    flip = lambda d: d.select("lang", F.col("t").alias("s"), F.col("s").alias("t"), "value")
    sums = single.unionByName(flip(single)).unionByName(common).unionByName(flip(common))
    sums = sums.groupBy("lang", "s", "t").agg(F.sum("value").alias("value"))
    one = groups.select("lang", F.col("place").alias("s"), "source", "zero", "terms")
    other = groups.select("lang", F.col("place").alias("t"), F.col("source").alias("item"), F.col("zero").alias("other"))
    pairs = one.join(other, "lang").filter("s != t").join(sums, ["lang", "s", "t"], "left")
    base = F.coalesce(F.col("terms") * F.abs(F.col("zero") - F.col("other")), F.lit(0))
    pairs = pairs.select("lang", "source", "item", (base + F.coalesce("value", F.lit(0))).cast("long").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(ranked))

    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(own.withColumn("part", F.lit("term")).select(columns))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
seen AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM seen GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
counts AS (SELECT lang, source, term, count(*) AS n FROM seen JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
totals AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM groups g LEFT JOIN counts c USING (lang, source) GROUP BY g.lang, g.source),
shares AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {SMOOTHING})) // (t.total + {SMOOTHING} * l.v) AS p,
    1 + ({SCALE}::HUGEINT * (k.n + {SMOOTHING})) // (l.total + {SMOOTHING} * l.v) AS q
    FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a
    JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source != a.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM groups a
    JOIN groups b ON b.lang = a.lang AND b.source != a.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
own AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
