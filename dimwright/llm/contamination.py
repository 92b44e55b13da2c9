"""Benchmark decontamination with suffix arrays over the training texts.

Each task turns its documents, some hundred at a time, into a shard: one array of word
numbers with a zero between documents.  Words that no benchmark item uses are zero as well, and a
suffix that meets a zero before the shortest window ends can hold no match, so the shard's suffix
array orders the remaining suffixes only, by as many words as the longest window has: that is
all a window's search compares.  Every suffix of every benchmark item is then binary-searched in it;
equal ranges are all the verbatim matches and their places.  Matches that continue one another, word
by word, form the longest match of a document and an item.

A window is ``window`` consecutive words of an item, or the whole item if it is shorter; an item
without words has none.  Words are runs of letters, digits and non-ASCII characters, with A-Z
lower-cased.  The benchmark is handed to the tasks in blocks of at most ``BLOCK_WORDS`` words.  One
block needs no shuffle; with more, each block's hits are written to the shared folder and
merged per document.

Null texts have no words.  Items with a null id are named ``null``; rows with the same item id are
one item.  Repeated documents give repeated rows.  An empty benchmark hits nothing.
"""

from __future__ import annotations

from itertools import repeat
from typing import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from dimwright.llm.common import add_columns, save_table, table

WINDOW = 10
#: words of benchmark text handed to the tasks at a time, and words of a shard
BLOCK_WORDS = 1_000_000
SHARD_WORDS = 1 << 19

#: bytes: A-Z to a-z, other ASCII than letters and digits to space, the rest unchanged
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
                    for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Block:
    """Some benchmark items: word numbers, and their distinct windows by length, as arrays."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        import numpy as np

        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        number = {n: i for i, n in enumerate(self.names)}
        texts = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.uint32) for _, words in items]
        #: width -> (sorted distinct windows, item and place of each occurrence, first occurrence of each window)
        self.arrays = {}
        for width in sorted({min(window, len(t)) for t in texts} - {0}):
            here = [i for i, t in enumerate(texts) if min(window, len(t)) == width]
            keys = byte_keys(np.concatenate([np.lib.stride_tricks.sliding_window_view(texts[i], width) for i in here]).astype(">u4"))
            many = [len(texts[i]) - width + 1 for i in here]
            item = np.repeat(np.array([number[items[i][0]] for i in here], np.int32), many)
            place = np.concatenate([np.arange(n, dtype=np.int32) for n in many])
            order = np.lexsort([place, item, keys])
            keys, item, place = keys[order], item[order], place[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.arrays[width] = (keys[first], item, place, np.append(first, len(keys)))


def byte_keys(matrix):
    """Rows of big-endian numbers as byte strings that sort like the rows."""
    import numpy as np

    return np.ascontiguousarray(matrix).view(f"S{4 * matrix.shape[1]}").ravel()


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[Block]:
    held, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("id"),
                            F.col(f"`{text_col}`").alias("text"))
    for r in rows.toLocalIterator():
        words = words_of(r["text"])
        if held and size + len(words) > BLOCK_WORDS:
            yield Block(held, window)
            held, size = [], 0
        held.append((r["id"], words))
        size += len(words)
    yield Block(held, window)


def expand(starts, counts):
    """Indices starts[i], starts[i]+1, ... (counts[i] of them) for each i, and the i of each."""
    import numpy as np

    which = np.repeat(np.arange(len(counts)), counts)
    return np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[which], which


def search_shard(texts_ids: list, arrays: dict):
    """Matches in a shard: (document, item, document word, item word, words) arrays, and hit words per document.

    ``texts_ids`` holds an array of word numbers per document."""
    import numpy as np

    size = np.array([len(t) for t in texts_ids])
    depth, least = max(arrays), min(arrays)
    start = np.cumsum(size + 1) - size - 1
    total = int((size + 1).sum())
    t = np.zeros(total + depth, np.uint32)
    for s, ids in zip(start, texts_ids):
        t[s:s + len(ids)] = ids
    # known words from each place on
    zero = np.flatnonzero(t[:total + 1] == 0)
    nxt = zero[np.searchsorted(zero, np.arange(total))]
    places = np.flatnonzero(nxt - np.arange(total) >= least)
    owner_of = np.repeat(np.arange(len(texts_ids)), size + 1)
    matrix = t[places[:, None] + np.arange(depth)].astype(">u4")
    order = np.argsort(byte_keys(matrix), kind="stable")
    suffixes, matrix = places[order], matrix[order]
    hit = np.zeros(total + depth + 1, np.int64)
    found = []
    for width, (keys, item, place, first) in arrays.items():
        column = byte_keys(matrix[:, :width])
        lo, hi = np.searchsorted(column, keys, "left"), np.searchsorted(column, keys, "right")
        some = np.flatnonzero(hi > lo)
        at, which = expand(lo[some], (hi - lo)[some])
        at, window = suffixes[at], some[which]
        np.add.at(hit, at, 1)
        np.add.at(hit, at + width, -1)
        occ, which = expand(first[window], (first[window + 1] - first[window]))
        found.append(np.stack([owner_of[at[which]], item[occ], at[which], place[occ], np.full(len(occ), width)]))
    n_hit = np.bincount(owner_of, np.cumsum(hit)[:total] > 0, len(texts_ids)).astype(np.int64)
    found = np.concatenate(found, axis=1)
    found[2] -= start[found[0]]
    return found, n_hit, np.cumsum(hit)[:total] > 0, start


def longest(found):
    """Longest match per (document, item): matches on one diagonal that follow each other join."""
    import numpy as np

    if not found.shape[1]:
        return found
    diagonal = found[2] - found[3]
    order = np.lexsort((found[2], diagonal, found[1], found[0]))
    f, diagonal = found[:, order], diagonal[order]
    new = np.ones(f.shape[1], bool)
    new[1:] = ((f[0, 1:] != f[0, :-1]) | (f[1, 1:] != f[1, :-1]) | (diagonal[1:] != diagonal[:-1])
               | (f[2, 1:] != f[2, :-1] + 1))
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(new)) - 1
    runs = f[:, head].copy()
    runs[4] = f[2, last] + f[4, last] - f[2, head]
    order = np.lexsort((runs[3], runs[2], -runs[4], runs[1], runs[0]))
    runs = runs[:, order]
    new = np.ones(runs.shape[1], bool)
    new[1:] = (runs[0, 1:] != runs[0, :-1]) | (runs[1, 1:] != runs[1, :-1])
    return runs[:, new]


MATCH = StructType([StructField("item_id", StringType()), StructField("doc_word", LongType()),
                    StructField("item_word", LongType()), StructField("n_words", LongType())])
HITS = [StructField("n_words", LongType()), StructField("n_hit", LongType()),
        StructField("hit_runs", ArrayType(ArrayType(LongType()))), StructField("matches", ArrayType(MATCH))]


def scan_block(df: DataFrame, block: Block, text_col: str, keep: list[str] | None) -> DataFrame:
    """Append words, hit words, runs of hit words and the longest match per item, for one block."""
    shared = df.sparkSession.sparkContext.broadcast(block)

    def make():
        import numpy as np

        b = shared.value
        arrays, get, names = b.arrays, b.vocabulary.get, b.names

        def shard(ids):
            if not arrays or not any(len(i) for i in ids):
                return [(len(i), 0, [], []) for i in ids]
            found, n_hit, hit, start = search_shard(ids, arrays)
            matches = [[] for _ in ids]
            for d, item, at, place, n in longest(found).T.tolist():
                matches[d].append((names[item], at, place, n))
            out = []
            for d, i in enumerate(ids):
                runs = []
                if n_hit[d]:
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[start[d]:start[d] + len(i)], [0]])))
                    runs = edge.reshape(-1, 2).tolist()
                out.append((len(i), int(n_hit[d]), runs, matches[d]))
            return out

        def fn(texts):
            out, held, size = [], [], 0
            for t in texts:
                words = words_of(t)
                held.append(np.fromiter(map(get, words, repeat(0)), np.uint32, len(words)))
                size += len(words)
                if size > SHARD_WORDS:
                    out += shard(held)
                    held, size = [], 0
            return out + (shard(held) if held else [])

        return fn

    return add_columns(df, [text_col], HITS, make, keep=keep)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """Append ``n_words``, ``n_hit``, ``hit_runs`` (pairs of first word and end) and ``matches`` to the ``keep``
    columns of ``docs`` (default: all)."""
    keep = list(docs.columns if keep is None else keep)
    blocks = blocks_of(benchmark, item_id, item_text, window)
    block = next(blocks)
    following = next(blocks, None)
    if following is None:
        return scan_block(docs, block, text_col, keep)
    # several blocks: rows with hits of each, merged by the row's text
    keyed = docs.withColumns({"__h1": F.xxhash64(F.col(f"`{text_col}`")), "__h2": F.xxhash64(F.lit(1), F.col(f"`{text_col}`"))})
    parts = []
    while block is not None:
        part = scan_block(keyed.filter(F.col(f"`{text_col}`").isNotNull()), block, text_col, ["__h1", "__h2"])
        parts.append(save_table(part.filter("n_hit > 0").dropDuplicates(["__h1", "__h2"]), "benchmark-hits"))
        block, following = following, next(blocks, None)
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)
    hits = hits.groupBy("__h1", "__h2").agg(F.flatten(F.collect_list("hit_runs")).alias("__runs"),
                                            F.flatten(F.collect_list("matches")).alias("__matches"))
    merged = F.aggregate(F.array_sort("__runs"), F.array().cast("array<array<bigint>>"), lambda acc, r: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)[1] >= r[0]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.array(F.element_at(acc, -1)[0], F.greatest(
            F.element_at(acc, -1)[1], r[1]))))).otherwise(F.concat(acc, F.array(r))))
    hits = hits.select("__h1", "__h2", merged.alias("__runs"), "__matches")
    counted = scan_block(keyed, Block([]), text_col, [*keep, "__h1", "__h2"]).drop("n_hit", "hit_runs", "matches")
    out = counted.join(hits, ["__h1", "__h2"], "left")
    runs = F.coalesce("__runs", F.array().cast("array<array<bigint>>"))
    return out.select(*[F.col(f"`{c}`") for c in keep if c not in ("n_words", "n_hit", "hit_runs", "matches")], "n_words",
                      F.aggregate(runs, F.lit(0).cast("long"), lambda a, r: a + r[1] - r[0]).alias("n_hit"),
                      runs.alias("hit_runs"), F.coalesce("__matches", F.array().cast(ArrayType(MATCH))).alias("matches"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    items = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS k FROM (
    SELECT item_id, w, least(10, len(w)) AS width, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
    FROM iw WHERE len(w) > 0)),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM dw),
grams AS (SELECT doc_id, i, x.width, array_to_string(w[i:i + x.width - 1], ' ') AS k
    FROM pos, (SELECT DISTINCT width FROM win) x WHERE i + x.width - 1 <= len(w)),
hits AS (SELECT g.doc_id, g.i, g.width, win.item_id FROM grams g JOIN win ON win.width = g.width AND win.k = g.k),
words_hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + width)) AS p FROM hits) GROUP BY doc_id),
items_hit AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (
    SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, cast(len(dw.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""
