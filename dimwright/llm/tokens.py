"""Token counts by a compiled finite-state transducer.

The tokenizer (a byte-fallback BPE model file) is compiled, lazily, into a deterministic
transducer.  A *safe cut* is a place that no vocabulary piece can lie across (before a run of
spaces, beside a character that no piece contains), so no merge can ever reach over it.
At a safe cut the transducer is always in its start state; between two cuts it reads one
run of characters.  Each distinct run is one transition, start state to start state,
annotated with the number of tokens it emits.  Transitions that a batch needs and that
are not compiled yet are compiled together: the merges of all those runs advance in step
as vectorised array operations.

What a chunk of text does to *any* entry state has a compact form (``StateMap``): the text
before its first cut, the tokens emitted between its first and last cut, and the text
after its last cut.  Maps compose associatively, so the chunks of a text can be mapped
independently and combined by a balanced (parallel prefix) tree; the result equals one pass.

Null text counts as empty (0 bytes, 0 tokens).  Repeated rows give repeated rows; other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import heapq
import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from dimwright.llm.common import add_columns, table

#: characters per chunk; each chunk gets its own state map
CHUNK_CHARS = 1 << 16
#: longer runs are counted one by one (a heap of merges) and not remembered
MAX_ARC_CHARS = 48
#: compiled transitions kept per worker; beyond it the table starts afresh
MAX_ARCS = 500_000
#: characters of text whose runs are held at a time
STEP_CHARS = 1 << 21

#: the model writes a space as this character
SPACE = "▁"


class StateMap(NamedTuple):
    """Effect of a chunk on any entry state: ``tail`` is None while the chunk has no cut."""

    head: str
    inner: int
    tail: str | None


class TokenTransducer:
    """Counts the tokens of a SentencePiece BPE model with byte fallback."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(SentencePieceProcessor(model_file=model_file).serialized_model_proto())
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if (train.model_type != train.BPE or not train.byte_fallback or norm.precompiled_charsmap
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or train.treat_whitespace_as_suffix):
            raise ValueError("the transducer needs a BPE model with byte fallback and plain white space")
        normal = proto.SentencePiece.NORMAL
        if any(p.type == proto.SentencePiece.USER_DEFINED for p in proto.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        ranked = sorted((p for p in proto.pieces if p.type == normal), key=lambda p: -p.score)
        self.rank = {p.piece: i for i, p in enumerate(ranked)}
        self.pairs = {p[i:i + 2] for p in self.rank for i in range(len(p) - 1)}
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("pieces that span words are not supported")
        # every place before a space run is a safe cut; so is any place beside a character
        # that occurs in no piece, such as the line feed of most models
        alone = "" if "\n" in self.rank or any("\n" in x for x in self.pairs) else "\n"
        self.runs_of = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|{alone}" if alone else "")).findall
        self.arcs: dict[str, int] = {}
        self._symbol = None  # tables of the vectorised merges, built on first use

    # -- compiling transitions ------------------------------------------------
    def _tables(self) -> None:
        """Symbol of each character, and the rank of each mergeable pair as hashed tables."""
        import numpy as np

        self._symbol = np.full(0x110000, -1, np.int64)
        for piece, r in self.rank.items():
            if len(piece) == 1:
                self._symbol[ord(piece)] = r
        pairs = {}
        for piece, r in self.rank.items():
            for i in range(1, len(piece)):
                left, right = self.rank.get(piece[:i]), self.rank.get(piece[i:])
                if left is not None and right is not None:
                    pairs[(left << 20) | right] = r
        keys = np.array(sorted(pairs), np.int64)
        ranks = np.array([pairs[int(k)] for k in keys], np.int64)
        self._levels = []
        for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                     0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3):
            slot = ((keys.view(np.uint64) * np.uint64(salt)) >> np.uint64(44)).astype(np.int64)
            table, value = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, np.int32)
            table[slot], value[slot] = keys, ranks
            here = table[slot] == keys
            self._levels.append((np.uint64(salt), table, value))
            keys, ranks = keys[~here], ranks[~here]
            if not len(keys):
                return
        raise ValueError("pair table is not complete")

    def _pair_ranks(self, left, right):
        """Rank of merging ``left`` and ``right``; ``NONE`` where they do not merge."""
        import numpy as np

        key = (left << 20) | right
        key[(left < 0) | (right < 0)] = -2
        out = np.full(key.shape, self.NONE, np.int64)
        for n, (salt, table, value) in enumerate(self._levels):
            slot = ((key.view(np.uint64) * salt) >> np.uint64(44)).astype(np.int64)
            hit = table[slot] == key
            out[hit] = value[slot[hit]]
        return out

    NONE = 1 << 40

    def compile(self, runs: list[str]) -> None:
        """Add the transitions of ``runs`` (each at most ``MAX_ARC_CHARS`` long)."""
        if self._symbol is None:
            self._tables()
        by_width: dict[int, list[str]] = {}
        for r in runs:
            by_width.setdefault((len(r) + 3) // 4 * 4, []).append(r)
        for width, group in by_width.items():
            for i in range(0, len(group), 8192):
                part = group[i:i + 8192]
                self.arcs.update(zip(part, self._merge_counts(part, width)))

    def _merge_counts(self, runs: list[str], width: int) -> list[int]:
        """Tokens of each run: merge the best-ranked neighbours, leftmost first, until none is left."""
        import numpy as np

        n = len(runs)
        chars = np.frombuffer("".join(r.ljust(width, "\0") for r in runs).encode("utf-32-le", "surrogatepass"),
                              np.uint32).reshape(n, width)
        size = np.array([len(r) for r in runs])
        inside = np.arange(width) < size[:, None]
        sym = np.where(inside, self._symbol[chars], -2)
        # a character without a symbol is spelt in bytes
        extra = np.where(inside & (sym == -1), (chars > 0x7F).astype(np.int64) + (chars > 0x7FF) + (chars > 0xFFFF), 0)
        total = size + extra.sum(axis=1)
        rank = np.full((n, width), self.NONE, np.int64)
        rank[:, :-1] = self._pair_ranks(sym[:, :-1], sym[:, 1:])
        row = np.arange(n)
        col = np.arange(width)
        while len(row):
            at = rank.argmin(axis=1)
            best = np.take_along_axis(rank, at[:, None], 1)[:, 0]
            go = best < self.NONE
            if not go.all():
                row, at, best, sym, rank = row[go], at[go], best[go], sym[go], rank[go]
                if not len(row):
                    break
            total[row] -= 1
            k = np.arange(len(row))
            sym[k, at] = best
            take = np.minimum(col + (col > at[:, None]), width - 1)
            sym = np.take_along_axis(sym, take, 1)
            sym[:, -1] = -2
            take = np.minimum(col + (col >= at[:, None]), width - 1)
            rank = np.take_along_axis(rank, take, 1)
            rank[:, -1] = self.NONE
            nxt = np.minimum(at + 1, width - 1)
            rank[k, at] = np.where(at + 1 < width, self._pair_ranks(sym[k, at], sym[k, nxt]), self.NONE)
            prev = np.maximum(at - 1, 0)
            rank[k, prev] = np.where(at > 0, self._pair_ranks(sym[k, prev], sym[k, at]), rank[k, prev])
        return total.tolist()

    def _merge_count_long(self, run: str) -> int:
        rank, n = self.rank, len(run)
        part, left, right = list(run), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank.get(run[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j >= n or len(part[i]) + len(part[j]) != size:
                continue
            part[i] += part[j]
            alive[j] = False
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := rank.get(part[i] + part[k])) is not None:
                    heapq.heappush(heap, (r, i, len(part[i]) + len(part[k])))
            if (h := left[i]) >= 0 and (r := rank.get(part[h] + part[i])) is not None:
                heapq.heappush(heap, (r, h, len(part[h]) + len(part[i])))
        return sum(1 if p in rank else len(p.encode("utf-8")) for p, a in zip(part, alive) if a)

    # -- reading text ---------------------------------------------------------
    def count_runs(self, texts: list[str]) -> list[int]:
        """Tokens of texts that start and end at a cut."""
        split = [self.runs_of(t) for t in texts]
        if len(self.arcs) > MAX_ARCS:
            self.arcs = {}
        arcs = self.arcs
        todo = [r for r in set().union(*split) if r not in arcs]
        long = [r for r in todo if len(r) > MAX_ARC_CHARS]
        self.compile([r for r in todo if len(r) <= MAX_ARC_CHARS] if long else todo)
        if not long:
            return [sum(map(arcs.__getitem__, runs)) for runs in split]
        return [sum(arcs[r] if r in arcs else self.long_run(r) for r in runs) for runs in split]

    def long_run(self, run: str) -> int:
        """A run too long to keep: cut it wherever no piece holds the two neighbours, and merge each part."""
        total, start, pairs = 0, 0, self.pairs
        for i in range(1, len(run)):
            if run[i - 1:i + 1] not in pairs:
                total += self._merge_count_long(run[start:i])
                start = i
        return total + self._merge_count_long(run[start:])

    def count_escaped(self, text: str) -> int:
        return self.count_runs([text])[0]

    # -- chunk maps -----------------------------------------------------------
    def chunk_map(self, escaped: str) -> StateMap:
        runs = self.runs_of(escaped)
        if len(runs) < 2:
            return StateMap(escaped, 0, None)
        head, tail = runs[0], runs[-1]
        return StateMap(head, self.count_escaped(escaped[len(head):len(escaped) - len(tail)]), tail)

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        if a.tail is None:
            return StateMap(a.head + b.head, b.inner, b.tail) if b.tail is not None else self.chunk_map(a.head + b.head)
        if b.tail is None:
            return self._close(a, a.tail + b.head)
        return StateMap(a.head, a.inner + self.count_escaped(a.tail + b.head) + b.inner, b.tail)

    def _close(self, a: StateMap, tail: str) -> StateMap:
        m = self.chunk_map(tail)
        if m.tail is None:
            return StateMap(a.head, a.inner, tail)
        return StateMap(a.head, a.inner + self.count_escaped(m.head) + m.inner, m.tail)

    def scan(self, maps: list[StateMap]) -> StateMap:
        """Balanced composition of neighbouring maps."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str | None, chunk_chars: int = CHUNK_CHARS) -> int:
        if not text:
            return 0
        text = self.prefix + text.replace(" ", SPACE)
        if len(text) <= chunk_chars:
            return self.count_escaped(text)
        m = self.scan([self.chunk_map(text[i:i + chunk_chars]) for i in range(0, len(text), chunk_chars)])
        return self.count_escaped(m.head) + m.inner + self.count_escaped(m.tail or "")

    def count_many(self, texts: list[str]) -> list[int]:
        """``count`` of each text; short texts share the compilation of their transitions."""
        out, held, chars = [0] * len(texts), [], 0
        for i, t in enumerate(texts):
            if len(t) >= CHUNK_CHARS:
                out[i] = self.count(t)
            elif t:
                held.append(i)
                chars += len(t)
            if held and chars > STEP_CHARS:
                for k, n in zip(held, self.count_runs([self.prefix + texts[k].replace(" ", SPACE) for k in held])):
                    out[k] = n
                held, chars = [], 0
        if held:
            for k, n in zip(held, self.count_runs([self.prefix + texts[k].replace(" ", SPACE) for k in held])):
                out[k] = n
        return out


_COMPILED: dict[str, TokenTransducer] = {}


def transducer(model_file: str) -> TokenTransducer:
    """One compiled transducer per worker process and model."""
    if model_file not in _COMPILED:
        _COMPILED[model_file] = TokenTransducer(model_file)
    return _COMPILED[model_file]


def count_tokens(df: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` per row of ``df``.

    ``model_file`` must be readable on every worker (it is part of the workers' environment).
    """

    def make():
        t = transducer(model_file)
        return lambda texts: [(n,) for n in t.count_many(texts)]

    src = df.select(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    src = src.withColumn("n_bytes", F.octet_length("__text").cast("long"))
    out = add_columns(src, ["__text"], [StructField("n_tokens", LongType())], make, keep=[id_col, "n_bytes"])
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
