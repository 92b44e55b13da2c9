"""Near-duplicate documents by SuperMinHash.

A document is the set of its distinct word shingles.  SuperMinHash walks a random permutation
of the signature's slots per element: its j-th step writes j plus a random fraction into one
slot, so every element fills slots evenly (lower variance than independent hashes) and a step can
be left out as soon as all slots hold less than j.  Signatures are cut into bands; sets
that agree in a band share a bucket.

Documents with equal sets collapse into one node first.  Inside a bucket every node is compared
with the bucket's first node, which needs as many comparisons as members; links that
pass the exact comparison of the full sets are united.  Where a bucket still holds several components,
the members outside its largest one are compared with another centre from that.  What is left outside
then meets the other members in tiles of bounded size: counts of each set's shingles over a few
hundred bins bound an intersection from above, and only pairs that this bound admits are
compared in full.  So every pair that shares a bucket is compared, excluded by an exact bound, or already in
one component: the components are those of all links among bucket neighbours.

Empty and null texts have the empty set and link with nothing.  Rows with the same id are one
document; a null id takes part through its text, and is kept only if its whole component has no
id.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from dimwright.llm.common import add_columns, save_table, table
from dimwright.llm.graph import connected_components

#: 32 bands of 6: a pair at similarity 0.8 shares no band with a chance of 6 in 100,000
BANDS, ROWS = 32, 6
#: elements whose permutations are held at a time
STEP_ELEMENTS = 1 << 16
#: bins of the shingle counts, and members of a tile
BINS, TILE = 256, 256
#: distinct words remembered per worker
MAX_WORDS = 250_000
#: texts shingled together
STEP_TEXTS = 64

_M1, _M2, _GOLD = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


def mix(x):
    """Finalizer of splitmix64 over an array of uint64."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(_M1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_M2)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash per word; the table starts afresh when it is full."""

    def __init__(self):
        from xxhash import xxh3_64_intdigest

        super().__init__()
        self.digest = xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        h = self[word] = self.digest(word)
        return h


def shingle_sets(texts: list, width: int, hashes: WordHashes) -> list:
    """Per text, the sorted distinct hashes of its shingles of ``width`` words; a shorter text is one shingle.

    A-Z are lower-cased; words are separated by space, tab, line feed, vertical tab, form feed, return.
    """
    import numpy as np

    get, out = hashes.__getitem__, []
    for lo in range(0, len(texts), STEP_TEXTS):
        words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts[lo:lo + STEP_TEXTS]]
        size = [len(w) for w in words]
        h = np.fromiter((x for w in words for x in map(get, w)), np.uint64, sum(size))
        end = len(h) - width + 1
        long = np.full(max(end, 0), width, np.uint64)
        for k in range(width if end > 0 else 0):
            long = mix((long + np.uint64(_GOLD)) ^ h[k:end + k])
        at = 0
        for n in size:
            if n >= width:
                one = np.sort(long[at:at + n - width + 1])
            else:
                one = np.full(min(n, 1), n, np.uint64)
                for k in range(n):
                    one = mix((one + np.uint64(_GOLD)) ^ h[at + k:at + k + 1])
            if len(one) > 1:
                one = one[np.concatenate([[True], one[1:] != one[:-1]])]
            out.append(one)
            at += n
    return out


def signatures(sets: list, slots: int):
    """SuperMinHash of each set: an array [sets, slots] of level + fraction (infinite for an empty set)."""
    import numpy as np

    sig = np.full((len(sets), slots), np.inf)
    flat = sig.reshape(-1)
    size = np.array([len(s) for s in sets])
    if not size.sum():
        return sig
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    start = np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32)
    for lo in range(0, len(elements), STEP_ELEMENTS):
        x, who = elements[lo:lo + STEP_ELEMENTS], owner[lo:lo + STEP_ELEMENTS]
        order = np.tile(start, (len(x), 1))
        row = np.arange(len(x))
        first, last = int(who[0]), int(who[-1]) + 1
        for j in range(slots):
            open_ = sig[first:last].max(axis=1) > j
            if not open_.any():
                break
            if not open_.all():
                go = open_[who - first]
                x, who, row = x[go], who[go], row[go]
                if not len(x):
                    break
            draw = mix(x + np.uint64((_GOLD * (2 * j + 1)) & 0xFFFFFFFFFFFFFFFF))
            k = j + ((mix(draw) >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
            slot = order[row, k]
            order[row, k] = order[row, j]
            np.minimum.at(flat, who * slots + slot, j + (draw >> np.uint64(11)) * 2.0 ** -53)
    return sig


def band_keys(sig, bands: int, rows: int):
    """One 64-bit key per set and band, as signed numbers."""
    import numpy as np

    bits = sig.view(np.uint64).reshape(len(sig), bands, rows)
    key = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64) + np.uint64(_GOLD)), bits.shape[:2]).copy()
    for r in range(rows):
        key = mix((key + np.uint64(_GOLD)) ^ bits[:, :, r])
    return key.view(np.int64)


def set_id(shingles) -> tuple[int, int]:
    """128-bit fingerprint of a set as two signed numbers."""
    import struct

    from xxhash import xxh3_128_digest

    return struct.unpack("<qq", xxh3_128_digest(shingles.tobytes()))


SIGNATURE = [StructField("n_shingles", LongType()), StructField("s1", LongType()), StructField("s2", LongType()),
             StructField("bands", ArrayType(LongType()))]
MEMBERS = [StructField("n_shingles", LongType()), StructField("shingles", ArrayType(LongType())),
           StructField("bins", BinaryType())]


def bin_counts(shingles) -> bytes:
    """How many shingles fall into each bin."""
    import numpy as np

    return np.bincount((shingles >> np.uint64(56)).astype(np.int64) % BINS, minlength=BINS).astype(np.uint32).tobytes()


def admitted(outside, members, num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of (node, component, size, bins) rows from different components that the bins do not exclude.

    The intersection of two sets is at most the sum over bins of the smaller count."""
    import numpy as np

    (o_id, o_c, o_n, o_bins), (m_id, m_c, m_n, m_bins), out = outside, members, []
    for node, c, n, bins in zip(o_id, o_c, o_n, o_bins):
        most = np.minimum(m_bins, bins).sum(axis=1)
        hit = (most * den >= (m_n + n - most) * num) & (m_c != c)
        out += [(min(int(node), int(x)), max(int(node), int(x))) for x in m_id[hit]]
    return out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    similarity: tuple[int, int] = (4, 5), bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id_col`` (as ``doc_id``), ``n_shingles``, ``component_id``, ``kept`` per row of ``df``."""
    signed, placed = _groups(df, id_col, text_col, width, similarity, bands, rows, [])
    # the smallest id of every component, for every document
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_set = placed.select("s1", "s2", "component").join(least, "component").select("s1", "s2", "component_id")
    out = signed.select("doc_id", "n_shingles", "s1", "s2").join(of_set, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))


def one_of_each_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                      similarity: tuple[int, int] = (4, 5), bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of ``df`` without their near duplicates, decided per row: of each component the document with the
    smallest id (then by a hash of its text) stays.  Rows with one id and one text are one document; rows without an
    id are a document each, and one of them stays only if no row of the component has an id.  Empty texts stay."""
    signed, placed = _groups(df.withColumn("__columns", F.struct(*[F.col(f"`{c}`") for c in df.columns])), id_col, text_col, width,
                             similarity, bands, rows, ["__columns"])
    # numbers are given once, as `signed` was written
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t1", "t2",
                    F.when(F.col("doc_id").isNull(), F.col("row")).otherwise(F.lit(0)).alias("tie"))
    component = placed.select("s1", "s2", "component")
    ranked = signed.withColumn("rank", rank).filter("n_shingles > 0")
    first = ranked.groupBy("s1", "s2").agg(F.min("rank").alias("first")).join(component, ["s1", "s2"])
    first = first.groupBy("component").agg(F.min("first").alias("first"))
    left = ranked.join(first.select(F.col("first").alias("rank")), "rank", "left_semi")
    return left.select("__columns.*").unionByName(signed.filter("n_shingles = 0").select("__columns.*"))


def _groups(df: DataFrame, id_col: str, text_col: str, width: int, similarity: tuple[int, int], bands: int, rows: int,
            keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """The signed rows (doc_id, ``keep``, row, text hashes t1 and t2, n_shingles, s1, s2) and the distinct sets (s1, s2,
    doc_id: smallest, component).

    ``similarity`` is a fraction: sets link if ``den * |both| >= num * |either|``.
    """
    num, den = similarity
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *keep).withColumns(
        {"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})

    def sign():
        hashes = WordHashes()

        def fn(texts):
            sets = shingle_sets(texts, width, hashes)
            keys = band_keys(signatures(sets, bands * rows), bands, rows).tolist()
            return [(len(s), *set_id(s), k if len(s) else None) for s, k in zip(sets, keys)]

        return fn

    signed = save_table(add_columns(docs, ["text"], SIGNATURE, sign, keep=["doc_id", *keep, "t1", "t2"])
                        .withColumn("row", F.monotonically_increasing_id()), "signatures")
    nodes = (signed.filter("n_shingles > 0").groupBy("s1", "s2")
             .agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "t1", "t2")).alias("at"), F.min("n_shingles").alias("n"), F.min("bands").alias("bands")))
    # numbers are given once, as the rows are written
    nodes = save_table(nodes.withColumn("node", F.monotonically_increasing_id()), "shingle-sets")

    # members of buckets that hold more than one node
    members = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
    members = save_table(members.join(buckets.select("bucket", "first"), "bucket"), "buckets")

    # full sets of those nodes, made again from their texts
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", "s1", "s2", F.col("at.doc_id").alias("at"), "at.t1", "at.t2")

    def expand():
        hashes = WordHashes()

        def fn(texts, s1, s2):
            sets = shingle_sets(texts, width, hashes)
            return [(len(s), s.view("int64").tolist(), bin_counts(s)) if set_id(s) == (a, b) else (0, None, None)
                    for s, a, b in zip(sets, s1, s2)]

        return fn

    # one text per set, found by id and text hash: a hot or null id is no hot key, repeated rows count once
    full = docs.drop(*keep).join(wanted, ["t1", "t2"]).filter(F.col("doc_id").eqNullSafe(F.col("at"))).select("node", "s1", "s2", "text")
    full = full.dropDuplicates(["node"])
    full = save_table(add_columns(full, ["text", "s1", "s2"], MEMBERS, expand, keep=["node"]).filter("n_shingles > 0"), "members")

    def verify(pairs: DataFrame) -> DataFrame:
        """The pairs (a < b, with set sizes) that link."""
        pairs = pairs.filter(F.least("na", "nb") * den >= F.greatest("na", "nb") * num).select("a", "b").distinct()
        left = full.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("shingles").alias("sa"))
        right = full.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("shingles").alias("sb"))
        joined = pairs.join(left, "a").join(right, "b")
        both = F.size(F.array_intersect("sa", "sb"))
        return save_table(joined.filter(both * den >= (F.col("na") + F.col("nb") - both) * num).select("a", "b"), "verified")

    def ordered(x: str, nx: str, y: str, ny: str) -> list:
        less = F.col(x) < F.col(y)
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b"),
                F.when(less, F.col(nx)).otherwise(F.col(ny)).alias("na"),
                F.when(less, F.col(ny)).otherwise(F.col(nx)).alias("nb")]

    sizes = nodes.select(F.col("node").alias("first"), F.col("n").alias("n_first"))
    star = members.filter("node != first").select("node", "n", "first").distinct().join(sizes, "first")
    links = verify(star.select(*ordered("node", "n", "first", "n_first")))
    labels = connected_components(links)

    def open_buckets() -> DataFrame:
        """Members of buckets of more than two that hold several components, with the largest one (``main``) and a
        member of it (``y``, ``ny``)."""
        placed = members.join(labels, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("c"))
        each = placed.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("k"),
                                                 F.min(F.struct(F.xxhash64("bucket", "node").alias("h"), "node", "n")).alias("m"))
        top = each.groupBy("bucket").agg(F.max(F.struct("k", "c", "m")).alias("top"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("parts"))
        top = top.filter("parts > 1 and k > 2").select("bucket", "k", F.col("top.k").alias("k_main"), F.col("top.c").alias("main"),
                                                       F.col("top.m.node").alias("y"), F.col("top.m.n").alias("ny"))
        return save_table(placed.join(top, "bucket"), "open-buckets")

    placed = open_buckets()
    found = verify(placed.filter("c != main").select(*ordered("node", "n", "y", "ny")))
    if not found.isEmpty():
        links = links.unionByName(found)
        labels = connected_components(links)
        placed = open_buckets()

    # what is outside a bucket's largest component against all its members, in tiles
    bins = full.select("node", "bins").distinct()
    sides = placed.join(bins, "node").withColumns({
        "mb": F.ceil(F.col("k") / F.lit(TILE)).cast("int"), "ob": F.ceil((F.col("k") - F.col("k_main")) / F.lit(TILE)).cast("int")})
    block = lambda n: F.pmod(F.xxhash64("bucket", "node", F.lit(3)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    shape = ["node", "c", "n", "bins"]
    member = sides.select("bucket", block("mb").alias("m"), every("ob").alias("o"), F.lit(True).alias("member"), *shape)
    outside = sides.filter("c != main").select("bucket", every("mb").alias("m"), block("ob").alias("o"), F.lit(False).alias("member"), *shape)

    def tile(pdf):
        import numpy as np
        import pandas as pd

        groups = [(g["node"].to_numpy(), g["c"].to_numpy(), g["n"].to_numpy(),
                   np.frombuffer(b"".join(map(bytes, g["bins"])), np.uint32).reshape(len(g), BINS).astype(np.int64))
                  for g in (pdf[~pdf["member"]], pdf[pdf["member"]])]
        return pd.DataFrame(admitted(*groups, num, den), columns=["a", "b"]).astype("int64")

    pairs = member.unionByName(outside).groupBy("bucket", "m", "o").applyInPandas(
        tile, StructType([StructField("a", LongType()), StructField("b", LongType())]))
    found = verify(pairs.withColumns({"na": F.lit(1), "nb": F.lit(1)}))
    if not found.isEmpty():
        labels = connected_components(links.unionByName(found))

    return signed, nodes.join(labels, "node", "left").select("s1", "s2", "doc_id", F.coalesce("component", "node").alias("component"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)
