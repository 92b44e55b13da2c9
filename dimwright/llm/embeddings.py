"""Embedding near-duplicates over an inverted multi-index.

The two halves of the unit vectors get independent codebooks (k-means on a bounded sample); the
pair of nearest centroids is a vector's cell in the product grid.  A vector visits cells in the order of the sum of
its two squared half distances (the multi-sequence order: over both sorted lists of distances, the cells up to a
sum form a staircase) and stops at its home cell's sum plus a slack.  The slack is set for ``RECALL``: each vector of
the sample gets some partners planted at exactly the threshold, in random directions, and the slack is the quantile of what it takes for both
of the two to visit each other's home cell, so that they meet in one tile.  Partners above the threshold are nearer.  Links that some hundred
vectors of the sample have with the others raise the slack if theirs is larger, every vector weighing the same, so the
links of one hot group cannot outvote the rest.  Every member of a visited block of cells is compared exactly, in double
precision: nothing below the threshold is linked, and of the links above it a share of ``RECALL`` at least is found where
partners lie as the sample's do; ``RECALL`` = 1 visits every cell.

Vectors with equal components are one node with a weight, so groups of copies cost nothing.  Small cells
are packed into blocks, large ones cut into several.  A vector is sent to the tile of its own block
with each block it visits, and a tile compares its two sides in chunks of ``TILE``, every pair once, for both
ends.  A tile reports, for each of its vectors with a link, how many it links with, and the smallest nodes it came to
be connected with inside the tile; these stars keep every link's connection, so their
components are those of all links.

Null and empty vectors, zero vectors and vectors with null or non-finite components link with nothing; so
do vectors of different length with each other.  Rows with the same id are one vector each; null ids take part, are
counted as links, and are kept only if nothing in their component has an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from dimwright.llm.common import add_columns, bounded_rows, save_table, table
from dimwright.llm.graph import connected_components

#: sample for the codebooks: rows, and bytes at most
SAMPLE_ROWS, SAMPLE_BYTES = 16_000, 1 << 25
#: nodes in an average cell, and the largest codebook
CELL_ROWS, MAX_CENTROIDS = 8, 128
#: share of the links at the threshold to be found, and vectors of the sample whose own links are looked at
RECALL, SAMPLE_QUERIES = 0.9995, 1000
#: partners planted, up to 16 for each vector of the sample
PLANTED = 64_000
#: room for rounding in squared distances
SLACK = 1e-9
#: vectors compared with as many others at a time
TILE = 512
#: least number of blocks (work for all cores), and bytes of vectors in a block at most
BLOCKS, BLOCK_BYTES = 16, 1 << 23
#: different vector lengths in one table
MAX_LENGTHS = 64


def kmeans(x, k: int, rounds: int = 12):
    """Centroids of ``x``; empty clusters keep their centroid."""
    import numpy as np

    rng = np.random.default_rng(11)
    centroids = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = half_distances(x, centroids).argmin(axis=1)
        size = np.bincount(near, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        centroids[size > 0] = sums[size > 0] / size[size > 0][:, None]
    return centroids


def ordered(centroids):
    """Centroids sorted along the direction in which they differ most."""
    import numpy as np

    if not centroids.shape[1]:
        return centroids
    main = np.linalg.svd(centroids - centroids.mean(axis=0), full_matrices=False)[2][0]
    return centroids[np.argsort(centroids @ main, kind="stable")]


def half_distances(x, centroids):
    """Squared distances [rows, centroids]."""
    import numpy as np

    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1), 0)


class MultiIndex:
    """Codebooks of the two halves, and how far a vector goes on from its home cell."""

    def __init__(self, sample, n_nodes: int, threshold: float):
        import numpy as np

        d = sample.shape[1]
        self.cut = max(1, d // 2)
        k = int(np.clip(round((n_nodes / CELL_ROWS) ** 0.5), 1, MAX_CENTROIDS))
        halves = sample[:, :self.cut], sample[:, self.cut:]
        # in the order of their main direction, so that cells in one block lie near each other
        self.books = [ordered(kmeans(h, min(k, len(sample)))) for h in halves]
        self.cells = len(self.books[0]) * len(self.books[1])
        self.slack = self.needed(sample, threshold)

    def needed(self, sample, threshold: float) -> float:
        """What a visit may add to the home cell's sum of distances, for ``RECALL`` of the links."""
        import numpy as np

        if RECALL >= 1:
            return float("inf")
        rng = np.random.default_rng(7)
        planted = []
        for _ in range(max(1, min(16, PLANTED // max(1, len(sample))))):
            turn = rng.normal(size=sample.shape)
            turn -= (turn * sample).sum(axis=1)[:, None] * sample
            turn /= np.maximum(np.linalg.norm(turn, axis=1), 1e-12)[:, None]
            planted.append(self.excess(sample, threshold * sample + (1 - threshold ** 2) ** 0.5 * turn))
        out = [np.quantile(np.concatenate(planted), RECALL, method="higher")]
        queries, worst = sample[:SAMPLE_QUERIES], []
        hit = queries @ sample.T >= threshold
        hit[np.arange(len(queries)), np.arange(len(queries))] = False
        for q in np.flatnonzero(hit.any(axis=1)):
            partners = sample[hit[q]]
            worst.append(self.excess(np.repeat(queries[q:q + 1], len(partners), axis=0), partners).max())
        if worst:
            out.append(np.quantile(worst, RECALL, method="higher"))
        return float(max(out)) + SLACK

    def excess(self, x, y):
        """For pairs of rows: how far beyond their home cells' sums both have to go to visit each other's home cell."""
        import numpy as np

        def one_way(dist, other):
            at = np.arange(len(other[0]))
            return sum(d[at, o.argmin(axis=1)] - d.min(axis=1) for d, o in zip(dist, other))

        dx, dy = self.distances(x), self.distances(y)
        return np.maximum(one_way(dx, dy), one_way(dy, dx))

    def distances(self, x):
        return half_distances(x[:, :self.cut], self.books[0]), half_distances(x[:, self.cut:], self.books[1])

    def home(self, x):
        a, b = self.distances(x)
        return a.argmin(axis=1) * len(self.books[1]) + b.argmin(axis=1)

    def place(self, x):
        """Home cell of each row, and the cells it visits."""
        import numpy as np

        a, b = self.distances(x)
        home = a.argmin(axis=1) * len(self.books[1]) + b.argmin(axis=1)
        a, b = a - a.min(axis=1)[:, None], b - b.min(axis=1)[:, None]
        visits = (a[:, :, None] + b[:, None, :] <= self.slack).reshape(len(x), -1)
        return home, [np.flatnonzero(v) for v in visits]


def unpack(blobs):
    import numpy as np

    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1) if len(blobs) else np.zeros((0, 0))


class Blocks:
    """Blocks of the cells: the first block of each cell, and how many blocks start there (a large cell's parts)."""

    def __init__(self, members: dict[int, int], cells: int, rows: int, start: int):
        import numpy as np

        self.first, self.width = np.empty(cells, np.int64), {}
        self.end, filled = start, rows + 1
        for c in range(cells):
            n = members.get(c, 0)
            if filled + n > rows:
                parts = max(1, -(-n // rows))
                self.width[self.end], self.open = parts, self.end
                self.end, filled = self.end + parts, rows if parts > 1 else 0
            self.first[c], filled = self.open, filled + n

    def own(self, cell: int, node: int) -> int:
        first = int(self.first[cell])
        return first + (node * 0x9E3779B97F4A7C15 >> 29) % self.width[first]

    def of(self, cells) -> list[int]:
        """All blocks of some cells."""
        import numpy as np

        return [b for f in np.unique(self.first[cells]).tolist() for b in range(f, f + self.width[f])]


def link_tile(left, right, threshold: float):
    """Links between two blocks of (node, weight, vector), or inside one (``right`` is None): rows of (node, copies it
    links with, itself) and (node, 0, smaller node connected inside the tile)."""
    import numpy as np

    one = right is None
    l_id, l_weight, l = left
    r_id, r_weight, r = left if one else right
    l_least, l_links = l_id.copy(), np.zeros(len(l_id), np.int64)
    r_least, r_links = (l_least, l_links) if one else (r_id.copy(), np.zeros(len(r_id), np.int64))
    big, out = np.iinfo(np.int64).max, []
    for i in range(0, len(l_id), TILE):
        for j in range(i if one else 0, len(r_id), TILE):
            hit = l[i:i + TILE] @ r[j:j + TILE].T >= threshold
            twice = one and i == j  # both ends of a link are among the rows
            if twice:
                np.fill_diagonal(hit, False)
            rows, cols = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
            if not len(rows):
                continue
            hit = hit[rows][:, cols]
            rows, cols = rows + i, cols + j
            l_links[rows] += hit @ r_weight[cols]
            if not twice:
                r_links[cols] += l_weight[rows] @ hit
            v, m = l_least[rows], r_least[cols]
            while True:
                new_v = np.minimum(v, np.where(hit, m[None, :], big).min(axis=1))
                new_m = np.minimum(m, np.where(hit, new_v[:, None], big).min(axis=0))
                if (new_v == v).all() and (new_m == m).all():
                    break
                v, m = new_v, new_m
            # every fall of a label is a star's ray: the label before stays connected through its own
            for at, ids, least, new in ((rows, l_id, l_least, v), (cols, r_id, r_least, m)):
                fell = new < least[at]
                out += zip(ids[at[fell]].tolist(), [0] * int(fell.sum()), new[fell].tolist())
                least[at] = np.minimum(least[at], new)
    for ids, links in ((l_id, l_links),) if one else ((l_id, l_links), (r_id, r_links)):
        some = links > 0
        out += zip(ids[some].tolist(), links[some].tolist(), ids[some].tolist())
    return out


UNIT = [StructField("dim", IntegerType()), StructField("unit", BinaryType())]


def link_embeddings(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """``id_col`` (as ``vec_id``), ``n_links``, ``component_id``, ``kept`` per row of ``df``."""

    def unit():
        import numpy as np

        def fn(vectors):
            out = []
            for v in vectors:
                x = np.array([np.nan if c is None else c for c in v or ()], np.float64)
                norm = np.abs(x).max() if len(x) else 0.0
                if not np.isfinite(norm) or norm == 0:
                    out.append((None, None))
                    continue
                x = x / norm  # keeps very large and very small components in range
                out.append((len(x), (x / np.linalg.norm(x) + 0.0).tobytes()))
            return out

        return fn

    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector"))
    rows = add_columns(rows, ["vector"], UNIT, unit, keep=["vec_id"])
    rows = rows.withColumn("u1", F.xxhash64("unit")).withColumn("u2", F.xxhash64(F.lit(1), "unit"))
    rows = save_table(rows, "unit-vectors")
    # equal directions are one node; nodes are numbered once, as they are written
    nodes = (rows.filter("unit is not null").groupBy("u1", "u2")
             .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("weight"), F.min("dim").alias("dim"), F.min("unit").alias("unit")))
    nodes = save_table(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")

    sizes = {r["dim"]: r["count"] for r in bounded_rows(nodes.groupBy("dim").count(), MAX_LENGTHS, "vector lengths")}
    index = {}
    for dim, n in sizes.items():
        sample = nodes.filter(F.col("dim") == dim).orderBy(F.xxhash64(F.lit(5), "u1", "u2"), "u1", "u2").limit(
            max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim))))
        index[dim] = MultiIndex(unpack([bytes(r["unit"]) for r in sample.select("unit").collect()]), n, threshold)

    def home():
        def fn(dims, units):
            out = [None] * len(dims)
            for dim in set(dims):
                at = [i for i, d in enumerate(dims) if d == dim]
                for i, cell in zip(at, index[dim].home(unpack([units[i] for i in at]))):
                    out[i] = (int(cell),)
            return out

        return fn

    # members of each cell, of a bounded grid
    counts = bounded_rows(add_columns(nodes, ["dim", "unit"], [StructField("cell", LongType())], home, keep=["dim"]).groupBy("dim", "cell").count(),
                          MAX_LENGTHS * MAX_CENTROIDS ** 2, "cells")
    blocks, end = {}, 0
    for dim, n in sizes.items():
        rows_ = max(TILE, min(-(-n // BLOCKS), BLOCK_BYTES // (8 * dim)))
        blocks[dim] = Blocks({r["cell"]: r["count"] for r in counts if r["dim"] == dim}, index[dim].cells, rows_, end)
        end = blocks[dim].end

    def place():
        def fn(ids, dims, units):
            out = [None] * len(dims)
            for dim in set(dims):
                at = [i for i, d in enumerate(dims) if d == dim]
                for lo in range(0, len(at), 128):
                    part = at[lo:lo + 128]
                    for i, cell, visits in zip(part, *index[dim].place(unpack([units[i] for i in part]))):
                        own = blocks[dim].own(int(cell), ids[i])
                        out[i] = (own, sorted({own, *blocks[dim].of(visits)}))
            return out

        return fn

    placed = add_columns(nodes, ["node", "dim", "unit"], [StructField("own", LongType()), StructField("visits", ArrayType(LongType()))],
                         place, keep=["node", "weight", "unit"])
    sides = placed.select("node", "weight", "unit", "own", F.explode("visits").alias("other")).select(
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") <= F.col("other")).alias("left"),
        "node", "weight", "unit")

    def tile(pdf):
        import pandas as pd

        pdf = pdf.sort_values("node")
        left, right = [(g["node"].to_numpy(), g["weight"].to_numpy(), unpack([bytes(b) for b in g["unit"]]))
                       for g in (pdf[pdf["left"]], pdf[~pdf["left"]])]
        one = pdf["low"].iloc[0] == pdf["high"].iloc[0]
        found = link_tile(left, None if one else right, threshold) if one or len(left[0]) and len(right[0]) else []
        return pd.DataFrame(found, columns=["node", "links", "least"]).astype("int64")

    stars = save_table(sides.groupBy("low", "high").applyInPandas(
        tile, StructType([StructField(c, LongType()) for c in ("node", "links", "least")])), "tile-links")
    labels = connected_components(stars.filter("node != least"), "node", "least")
    counts = stars.groupBy("node").agg(F.sum("links").alias("links"))
    of_node = (nodes.select("node", "vec_id", "weight", "u1", "u2").join(labels, "node", "left").join(counts, "node", "left")
               .withColumn("component", F.coalesce("component", "node")))
    least = of_node.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    of_node = of_node.join(least, "component").select(
        "u1", "u2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"))
    out = rows.filter("unit is not null").join(of_node, ["u1", "u2"]).select("vec_id", F.col("n").cast("long").alias("n_links"), "component_id")
    out = out.unionByName(rows.filter("unit is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                             F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op1_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0),
ok AS (SELECT vec_id, e FROM v WHERE len([x FOR x IN e IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN e IF x <> 0]) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
cnt AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, c AS component_id, e.vec_id = c AS kept
FROM embeddings e JOIN comp ON comp.a = e.vec_id LEFT JOIN cnt ON cnt.a = e.vec_id
"""
