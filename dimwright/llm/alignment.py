"""Alignment of two tokenizers over the same bytes, by pointer jumping.

A is a byte-level BPE, B a byte-fallback piece model that puts a space before a text; A reads that space too, so both cover the
same bytes.  Every token points to the overlapping token of the other side that reaches farthest right, a token whose end is
an end of the other side too is where its component stops.  Doubling the successors of all tokens of a batch at once
(s = s[s] until nothing changes) brings every token to the last token of its component; tokens with the same last token are a
group.  Within a group every A token is linked with every B token.

A text is cut before every single space between two characters that no definition calls white space.  A's splitter starts a new
piece there, and no piece of B reaches over it, so the tokens of a text are those of its cuts, one after another.
Each distinct cut is tokenized and aligned once per worker and batch of new ones; a text adds up its cuts.

Over the whole corpus, an id pair's count is the number of documents that hold it linked.  A document's distinct pairs are stored
as numbers (A id * 2^32 + B id) with their links, and counted with partial sums.  The counts come back to the documents by two
joins: the pairs in the most documents, a bounded number, are broadcast; the others, none of which is in many documents, meet
what is left by a shuffle.  So a pair that a third of all documents hold never goes to one task.

Null and empty texts, and texts whose tokens do not give back their bytes (such as one that holds U+2581, which B writes for a space),
have no tokens: zeros and an empty string.  A row is a document: repeated rows count repeatedly.  Very long texts are aligned
cut by cut; one cut without a space is aligned as a whole.  Ties for an A id's highest count all count as best.  Other columns
stay in the general form; a column called like a new one is replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField

from dimwright.llm.common import add_columns, save_table, table

#: this many pairs (some 64 bytes each in a hashed relation) are broadcast at most, those in the most documents
BROADCAST_PAIRS = 1_000_000
#: cuts kept per worker, the longest cut kept, and characters of new cuts or of texts worked on at a time
MAX_CUTS, MAX_CUT_CHARS, STEP_CHARS = 400_000, 64, 1 << 20

#: no white space by any definition
_SURE = r"[^\s\u180e\u200b-\u200f\u2060\ufeff]"
CUT = re.compile(rf"(?<={_SURE}) (?={_SURE})")
SHIFT = 32


def byte_of_symbol() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes for U+0100 on."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in same]
    return {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(others)}


def expand(starts, counts):
    """Indices starts[i], starts[i]+1, ... (counts[i] of them) for each i, and the i of each."""
    import numpy as np

    which = np.repeat(np.arange(len(counts)), counts)
    return np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[which], which


def components(ends_a, ends_b):
    """Group of each A token and of each B token, numbered from 0 in order; ends are byte offsets over the same bytes.

    Successor doubling: tokens of A are nodes 0 .. n-1, tokens of B follow."""
    import numpy as np

    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # first B token that reaches at least as far: the farthest that overlaps
    over_b = np.searchsorted(ends_a, ends_b)
    # at a common end the A token is the last of its component, and B's points to it
    nxt = np.concatenate([np.where(ends_b[over_a] > ends_a, n + over_a, np.arange(n)), over_b])
    while True:
        further = nxt[nxt]
        if (further == nxt).all():
            break
        nxt = further
    last, group = np.unique(nxt, return_inverse=True)  # the last tokens are A's, in the order of their ends
    return group[:n], group[n:]


class Cuts:
    """Aligned cuts: a number for each, and by number its sizes, id pairs and text form."""

    def __init__(self, a_file: str, b_file: str):
        import numpy as np
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_padding()
        self.a.no_truncation()
        self.b = SentencePieceProcessor(model_file=b_file)
        symbols = byte_of_symbol()
        specials = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = specials[i] if i in specials else bytes(symbols[c] for c in token)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.size_a, self.size_b = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        # id and what follows it: 0 comma (more of this side), 1 bar (A ends), 2 semicolon (group ends)
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.written = [f"{i}{c}" for i in range(most) for c in ",|;"]
        self.forget()

    def forget(self) -> None:
        import numpy as np

        self.number: dict[str, int] = {}
        self.texts: list[str] = []
        #: per cut: A tokens, B tokens, groups, links, whether its bytes came back, first of its pairs and how many
        self.facts = np.zeros((7, 0), np.int64)
        self.pairs, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, cuts: list[str]) -> None:
        """Tokenize and align cuts not known yet; each starts with a space."""
        import numpy as np

        for chunk in in_steps(cuts):
            ids_a = [e.ids for e in self.a.encode_batch(chunk, add_special_tokens=False)]
            ids_b = self.b.encode([c[1:] for c in chunk], num_threads=1)
            want = [c.encode("utf-8", "surrogatepass") for c in chunk]
            a_of, b_of = self.a_bytes.__getitem__, self.b_bytes.__getitem__
            ok = [b"".join(map(a_of, a)) == w == b"".join(map(b_of, b)) for a, b, w in zip(ids_a, ids_b, want)]
            ids_a, ids_b = ([x if o else [] for x, o in zip(ids, ok)] for ids in (ids_a, ids_b))
            facts, pairs, links, texts = self.align(ids_a, ids_b)
            facts[4] = ok
            facts[5] += len(self.pairs)
            for c in chunk:
                self.number[c] = len(self.number)
            self.texts += texts
            self.facts = np.concatenate([self.facts, facts], axis=1)
            self.pairs, self.links = np.concatenate([self.pairs, pairs]), np.concatenate([self.links, links])

    def align(self, ids_a: list[list[int]], ids_b: list[list[int]]):
        """Facts, distinct pairs, their links, and text form of each of some cuts, all at once."""
        import numpy as np

        n = len(ids_a)
        facts = np.zeros((7, n), np.int64)
        facts[0], facts[1] = [len(x) for x in ids_a], [len(x) for x in ids_b]
        a, b = (np.fromiter((i for x in ids for i in x), np.int64) for ids in (ids_a, ids_b))
        if not len(a):
            return facts, a, a, [""] * n
        own_a, own_b = np.repeat(np.arange(n), facts[0]), np.repeat(np.arange(n), facts[1])
        group_a, group_b = components(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]))
        groups = int(group_a[-1]) + 1
        many_a, many_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        owner = np.zeros(groups, np.int64)
        owner[group_a] = own_a
        facts[2] = np.bincount(owner, minlength=n)
        np.add.at(facts[3], owner, many_a * many_b)
        # pairs: distinct ids of each side of a group with their number, then all combinations
        side = lambda g, ids: np.unique(g << SHIFT | ids, return_counts=True)
        (key_a, times_a), (key_b, times_b) = side(group_a, a), side(group_b, b)
        at_b = np.searchsorted(key_b >> SHIFT, key_a >> SHIFT)
        there = np.bincount(key_b >> SHIFT, minlength=groups)[key_a >> SHIFT]
        right, left = expand(at_b, there)
        low = (1 << SHIFT) - 1
        pair = (key_a[left] & low) << SHIFT | key_b[right] & low
        link = times_a[left] * times_b[right]
        cut = owner[key_a[left] >> SHIFT]
        order = np.lexsort([pair, cut])
        cut, pair, link = cut[order], pair[order], link[order]
        head = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (cut[1:] != cut[:-1])]))
        link, pair, cut = np.add.reduceat(link, head), pair[head], cut[head]
        facts[6] = np.bincount(cut, minlength=n)
        facts[5] = np.cumsum(facts[6]) - facts[6]
        # text form: A ids of a group, then its B ids
        before_a = np.concatenate([[0], np.cumsum(many_b)])[group_a]
        before_b = np.cumsum(many_a)[group_b]
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        flat = np.zeros(len(a) + len(b), np.int64)
        flat[np.arange(len(a)) + before_a] = a * 3 + last_a
        flat[np.arange(len(b)) + before_b] = b * 3 + np.where(last_b, 2, 0)
        written = list(map(self.written.__getitem__, flat.tolist()))
        end = np.cumsum(facts[0] + facts[1]).tolist()
        texts = ["".join(written[s:e])[:-1] for s, e in zip([0, *end], end)]
        return facts, pair, link, texts

    def documents(self, texts: list[str]):
        """(n_a, n_b, n_groups, n_links, sha256, pairs, their links) of each text; zeros without tokens."""
        out = []
        for chunk in in_steps(texts):
            out += self.chunk(chunk)
        return out

    def chunk(self, texts: list[str]):
        import numpy as np

        cuts = [[" " + c for c in CUT.split(t)] if t else [] for t in texts]
        if len(self.number) > MAX_CUTS:
            self.forget()
        number = self.number
        kept, after = len(number), [c for c in dict.fromkeys(c for x in cuts for c in x) if c not in number]
        long = [c for c in after if len(c) > MAX_CUT_CHARS]
        self.add([c for c in after if len(c) <= MAX_CUT_CHARS] + long)
        size = np.array([len(c) for c in cuts])
        which = np.fromiter((number[c] for x in cuts for c in x), np.int64, int(size.sum()))
        doc = np.repeat(np.arange(len(texts)), size)
        ok = (size > 0) & (np.bincount(doc, 1 - self.facts[4, which], len(texts)) == 0)
        sums = [np.bincount(doc, self.facts[k, which], len(texts)).astype(np.int64).tolist() for k in range(4)]
        # pairs of a document: those of its distinct cuts, times how often each occurs
        key, times = np.unique(doc << SHIFT | which, return_counts=True)
        doc, cut = key >> SHIFT, key & ((1 << SHIFT) - 1)
        at, of = expand(self.facts[5, cut], self.facts[6, cut])
        doc, pair, link = doc[of], self.pairs[at], self.links[at] * times[of]
        order = np.lexsort([pair, doc])
        doc, pair, link = doc[order], pair[order], link[order]
        if len(doc):
            head = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])]))
            doc, pair, link = doc[head], pair[head], np.add.reduceat(link, head)
        edge = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
        forms, rows, start = self.texts, [], 0
        for i, n in enumerate(size.tolist()):
            if ok[i]:
                form = ";".join([forms[c] for c in which[start:start + n].tolist()])
                rows.append((*(s[i] for s in sums), hashlib.sha256(form.encode()).hexdigest(), pair[edge[i]:edge[i + 1]], link[edge[i]:edge[i + 1]]))
            else:
                rows.append((0, 0, 0, 0, "", [], []))
            start += n
        if long:  # cuts too long to be worth keeping were added last
            self.drop(kept + len(after) - len(long), long)
        return rows

    def drop(self, first: int, cuts: list[str]) -> None:
        """Forget the cuts from number ``first`` on."""
        for c in cuts:
            del self.number[c]
        keep = int(self.facts[5, first])
        self.facts, self.texts = self.facts[:, :first], self.texts[:first]
        self.pairs, self.links = self.pairs[:keep], self.links[:keep]


def in_steps(texts: list[str]):
    """Consecutive texts of some ``STEP_CHARS`` characters together."""
    held, chars = [], 0
    for t in texts:
        held.append(t)
        chars += len(t)
        if chars > STEP_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


_CUTS: dict[tuple[str, str], Cuts] = {}


def cuts_of(a_file: str, b_file: str) -> Cuts:
    """One table of aligned cuts per worker process and pair of tokenizers."""
    if (a_file, b_file) not in _CUTS:
        _CUTS[a_file, b_file] = Cuts(a_file, b_file)
    return _CUTS[a_file, b_file]


ALIGNED = [StructField(n, LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")] + [
    StructField("groups_sha256", StringType()), StructField("pairs", ArrayType(LongType())), StructField("links", ArrayType(LongType()))]


def align_texts(df: DataFrame, a_file: str, b_file: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append token, group and link numbers, the groups' hash, and the distinct id pairs with their links to the ``keep`` columns.

    Both files must be readable on every worker (they are part of the workers' environment)."""

    def make():
        cuts = cuts_of(a_file, b_file)
        return lambda texts: cuts.documents([t or "" for t in texts])

    return add_columns(df, [text_col], ALIGNED, make, keep=keep)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``n_docs`` (documents that hold it linked) and ``best`` (no pair of its A id has more), one row per id pair."""
    counts = save_table(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs")), "pair-counts")
    a_id = F.shiftright("pair", SHIFT).alias("a")
    most = counts.groupBy(a_id).agg(F.max("n_docs").alias("most"))
    out = counts.select("*", a_id).join(most, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))
    return save_table(out, "pair-best")


def broadcast_floor(counts: DataFrame, limit: int) -> int:
    """The smallest power of two that at most ``limit`` pairs reach in documents."""
    bits = {r["bits"]: r["n"] for r in counts.groupBy(F.length(F.bin("n_docs")).alias("bits")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, least = 0, 1 << 63
    for k in range(63, 0, -1):  # at most 63 lengths of a positive count
        total += bits.get(k, 0)
        if total > limit:
            break
        least = 1 << (k - 1)
    return min(least, (1 << 63) - 1)


def align_corpus(df: DataFrame, a_file: str, b_file: str, text_col: str = "text", keep: list[str] | None = None,
                 broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``align_texts`` without the pair lists, and with ``n_best`` and ``count_sum``: the links whose count is their A id's highest, and
    the sum of the counts over the links."""
    new = {f.name for f in ALIGNED} | {"n_best", "count_sum"}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    # the row travels as one struct, so that no column of it can clash; its number is stored with it, and so stays
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    src = src.withColumn("nth", F.monotonically_increasing_id())
    aligned = save_table(align_texts(src, a_file, b_file, keep=["row", "nth"]), "aligned-texts")
    counts = pair_counts(aligned)
    least = broadcast_floor(counts, broadcast_pairs)
    links = aligned.select("nth", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("nth", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links"))
    often = F.broadcast(counts.filter(F.col("n_docs") >= least))
    counted = links.join(often, "pair")
    if least > 1:
        counted = counted.unionByName(links.join(often, "pair", "left_anti").join(counts.filter(F.col("n_docs") < least), "pair"))
    sums = counted.groupBy("nth").agg(F.sum(F.when(F.col("best"), F.col("links"))).alias("n_best"),
                                      F.sum(F.col("links") * F.col("n_docs")).alias("count_sum"))
    out = aligned.drop("pairs", "links").join(sums, "nth", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], *[f.name for f in ALIGNED[:4]], *zero, "groups_sha256")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    return align_corpus(table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"),
                        keep=["doc_id"])
