"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 that its code point alone decides.  The vector of
a letter trigram binds (multiplies) its letters' vectors, each rotated by its place; a text
bundles (adds) the vectors of its trigrams; a language prototype bundles its training texts.  A
text gets the language whose prototype has the largest cosine with it.

Prototypes are sums over all training rows, added up by Spark: one vector per task and language,
then one sum per language and component.  Languages are bounded (``MAX_LANGUAGES``), so the
prototypes are small whatever the corpus.

Texts are lower-cased; runs of anything but letters count as one space, and so do both ends.
A null text, or one without a letter, is ``und`` with score 0.  Equal cosines go to
the alphabetically first language.  The score is the cosine, at least 0.  Without a single
training row every text is ``und``.  Repeated rows train and count repeatedly.  An empty table gives an
empty result; columns called ``lang_pred`` or ``score`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from dimwright.llm.common import add_columns, bounded_rows, let_workers_import, table

#: components of a vector; more languages than this are an error
DIMENSION = 1024
MAX_LANGUAGES = 2000
#: trigrams whose vectors are held at a time, and characters of text read at a time
BLOCK_GRAMS = 4096
#: up to this many (trigram, text) pairs are counted in a table, more by sorting those that occur
DENSE_PAIRS = 1 << 22
STEP_CHARS = 1 << 19
STEP_TEXTS = 128

UNKNOWN = "und"
_SPACE = 32


class Encoder:
    """Text to bundled trigram vectors, in batches."""

    def __init__(self, dimension: int = DIMENSION):
        import numpy as np

        self.np, self.dimension = np, dimension
        self.letter_class = np.full(0x110000, -1, np.int32)  # code point -> itself or space; -1: not seen yet
        self.letter_class[_SPACE] = _SPACE
        self.vectors: dict[int, object] = {}

    def vector(self, code: int):
        v = self.vectors.get(code)
        if v is None:
            np = self.np
            bits = np.random.Generator(np.random.Philox(key=code)).integers(0, 2, self.dimension, np.int8)
            if len(self.vectors) > 20_000:
                self.vectors.clear()
            v = self.vectors[code] = bits * np.int8(2) - np.int8(1)
        return v

    def grams(self, texts: list[str]):
        """Distinct trigrams of a batch and where they are: (codes [g, 3], trigram, text and count of each pair that
        occurs, by trigram, has a letter [texts])."""
        np = self.np
        joined = np.frombuffer("".join(f" {t.lower()} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(t.lower()) + 2 for t in texts])
        owner = np.repeat(np.arange(len(texts)), size)
        codes = self.letter_class[joined]
        new = codes < 0
        if new.any():
            for c in np.unique(joined[new]):
                self.letter_class[c] = c if chr(c).isalpha() else _SPACE
            codes = self.letter_class[joined]
        space = codes == _SPACE
        # one space for each run of other characters, within a text
        keep = np.ones(len(codes), bool)
        keep[1:] = ~(space[1:] & space[:-1] & (owner[1:] == owner[:-1]))
        codes, owner = codes[keep], owner[keep]
        has_letter = np.bincount(owner, codes != _SPACE, len(texts)) > 0
        letters, small = np.unique(codes, return_inverse=True)
        k = len(letters)
        gram = (small[:-2].astype(np.int64) * k + small[1:-1]) * k + small[2:]
        inside = (owner[:-2] == owner[2:])
        gram, owner = gram[inside], owner[:-2][inside]
        if k ** 3 <= 1 << 22:
            present = np.flatnonzero(np.bincount(gram, minlength=k ** 3))
            index = np.zeros(k ** 3, np.int64)
            index[present] = np.arange(len(present))
            gram = index[gram]
        else:
            present, gram = np.unique(gram, return_inverse=True)
        n, pairs = len(texts), len(texts) * len(present)
        if pairs <= DENSE_PAIRS:
            counts = np.bincount(gram * n + owner, minlength=pairs)
            pair = np.flatnonzero(counts)
            counts = counts[pair]
        else:
            pair, counts = np.unique(gram * n + owner, return_counts=True)
        codes = np.stack([letters[present // (k * k)], letters[present // k % k], letters[present % k]], axis=1)
        return codes, pair // n, pair % n, counts, has_letter

    def bind(self, codes):
        """Vectors of trigrams: first letter rotated twice, second once, multiplied."""
        np = self.np
        letters, where = np.unique(codes, return_inverse=True)
        where = where.reshape(codes.shape)
        v = np.stack([self.vector(int(c)) for c in letters])
        return np.roll(v, 2, axis=1)[where[:, 0]] * np.roll(v, 1, axis=1)[where[:, 1]] * v[where[:, 2]]

    def bundle(self, texts: list[str]):
        """(vectors [texts, dimension], has a letter)."""
        np = self.np
        codes, gram, text, counts, has_letter = self.grams(texts)
        out = np.zeros((len(texts), self.dimension))
        for i in range(0, len(codes), BLOCK_GRAMS):
            block = codes[i:i + BLOCK_GRAMS]
            s, e = np.searchsorted(gram, [i, i + len(block)])
            dense = np.zeros((len(texts), len(block)), np.float32)
            dense[text[s:e], gram[s:e] - i] = counts[s:e]
            out += dense @ self.bind(block).astype(np.float32)
        return out, has_letter


def steps(texts):
    """Index ranges of consecutive texts, bounded in number and characters."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        if i > start and (chars + len(t) > STEP_CHARS or i - start >= STEP_TEXTS):
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, list[float]]:
    """Unit prototype per language from all rows of ``df`` with a language and a text."""
    schema = StructType([StructField("lang", StringType()), StructField("total", ArrayType(DoubleType()))])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        encoder, totals = Encoder(), {}
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for s, e in steps(texts):
                vectors, _ = encoder.bundle(texts[s:e])
                names = np.array(langs[s:e])
                for lang in set(langs[s:e]):
                    totals[lang] = totals.get(lang, 0.0) + vectors[names == lang].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()),
                                          pa.array([list(v) for v in totals.values()], pa.list_(pa.float64()))],
                                         names=["lang", "total"])

    let_workers_import(df.sparkSession)
    rows = df.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.filter("lang is not null and text is not null")
    sums = (rows.mapInArrow(run, schema).select("lang", F.posexplode("total").alias("at", "x"))
            .groupBy("lang", "at").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("parts"))
            .select("lang", F.col("parts.x").alias("total")))
    out = {}
    for r in bounded_rows(sums, MAX_LANGUAGES, "languages"):
        norm = sum(x * x for x in r["total"]) ** 0.5
        if norm:
            out[r["lang"]] = [x / norm for x in r["total"]]
    return out


def predict(df: DataFrame, prototypes: dict[str, list[float]], text_col: str = "text",
            keep: list[str] | None = None) -> DataFrame:
    """Append ``lang_pred`` and ``score`` to the ``keep`` columns of ``df``."""
    names = sorted(prototypes)
    matrix = [prototypes[n] for n in names]

    def make():
        import numpy as np

        encoder, table_of = Encoder(), np.array(matrix).T

        def fn(texts):
            texts, out = [t or "" for t in texts], []
            if not names:
                return [(UNKNOWN, 0.0)] * len(texts)
            for s, e in steps(texts):
                vectors, has_letter = encoder.bundle(texts[s:e])
                norm = np.linalg.norm(vectors, axis=1)
                cosine = np.round((vectors @ table_of) / np.where(norm > 0, norm, 1)[:, None], 9)
                best = cosine.argmax(axis=1)
                out += [(names[b], min(1.0, max(0.0, float(c[b])))) if ok else (UNKNOWN, 0.0)
                        for b, c, ok in zip(best, cosine, has_letter)]
            return out

        return fn

    return add_columns(df, [text_col], [StructField("lang_pred", StringType()), StructField("score", DoubleType())],
                       make, keep=keep)


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % F.lit(5) == F.lit(0)


def train_on_documents(docs: DataFrame) -> dict[str, list[float]]:
    """Prototypes from the documents that are not held out; a null id is not held out."""
    return train(docs.filter(~F.coalesce(held_out("doc_id"), F.lit(False))))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, train_on_documents(docs), keep=["doc_id"])
    return found.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "lang_pred", "score")
