import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dimwright.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "   ", "a", "  two  spaces  ", "<|endoftext|>", "x <|endoftext|> y", "</s> <s> <unk>", "<0x41> plain", "▁", "has ▁ inside", "tab\there\r\nline",
       "naïve Größe ñandú", "日本語のテキスト 中文", "😀😃 emoji 👩‍👩‍👧", "a b  c ​d", "\u0000 zero", "don't we'll I'd", "é combining",
       "x" * 3000, "ab " * 2000, "😀" * 700, "日本" * 2000, "﻿bom", "\u0085next line", "\x1c sep \x1d", "1234567890 12.5 % $", "᠎ old", "end  ", "\n\n", " \n x"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_groups(tokenizers, text):
    """(A ids, B ids) of each group of a whole text, by the definition; None without tokens."""
    a, b = tokenizers
    if not text:
        return None
    want = (" " + text).encode()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    symbols = alignment.byte_of_symbol()
    bytes_a = [bytes(symbols[c] for c in t) if i != 50256 else b"<|endoftext|>" for i, t in zip(ids_a, map(a.id_to_token, ids_a))]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, map(b.id_to_piece, ids_b))]
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
    cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    groups = [([], []) for _ in cuts]
    for side, (ids, ends) in enumerate(((ids_a, ends_a), (ids_b, ends_b))):
        for i, g in zip(ids, np.searchsorted(cuts, ends)):
            groups[g][side].append(i)
    return groups


def plain(tokenizers, texts):
    docs = [plain_groups(tokenizers, t) for t in texts]
    links = [Counter((x, y) for a, b in g or [] for x in a for y in b) for g in docs]
    count = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for g, c in zip(docs, links):
        form = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g or [])
        out.append((sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), sum(c.values()),
                    sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(form.encode()).hexdigest() if g else ""))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def run(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = alignment.align_corpus(df, A, B, keep=["doc_id"], **kw).select("doc_id", *COLUMNS).collect()
    return [tuple(r)[1:] for r in sorted(got)]


def test_whole_table_equals_the_definition(spark, tokenizers):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    got = alignment.op13_token_alignment(spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", *COLUMNS[:6], "groups_sha256"]
    ids = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("doc_id").to_pylist()
    want = {i: w for i, w in zip(ids, plain(tokenizers, texts))}
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 40, 0])
def test_odd_texts_and_both_joins(spark, tokenizers, limit):
    """Nulls, repeats, special strings, other scripts; counts that come back by the broadcast, by both joins, by the shuffle alone."""
    texts = ODD + ODD[4:9] + ["the same words again and again"] * 20
    assert run(spark, texts, broadcast_pairs=limit) == plain(tokenizers, texts)


def test_cuts_never_change_the_tokens(tokenizers):
    """Random strings of awkward characters, cut and whole."""
    rng, cuts = random.Random(5), alignment.Cuts(A, B)
    pieces = [" ", "  ", "a", "Z", "é", "日", "😀", "'s", "'", "1", ".", "\n", "\t", " ", "​", " ", "\x1c", "\u0085", "᠎", "<|endoftext|>", "the", "</s>",
              "́", "_", "　"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25))) for _ in range(3000)]
    for text, row in zip(texts, cuts.documents(texts)):
        g = plain_groups(tokenizers, text)
        form = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g or [])
        assert row[4] == (hashlib.sha256(form.encode()).hexdigest() if g else ""), repr(text)


def test_forgetting_cuts_changes_nothing(monkeypatch):
    texts = [t or "" for t in ODD] * 3
    want = [(r[:5], list(r[5]), list(r[6])) for r in alignment.Cuts(A, B).documents(texts)]
    monkeypatch.setattr(alignment, "MAX_CUTS", 3)
    monkeypatch.setattr(alignment, "MAX_CUT_CHARS", 4)
    monkeypatch.setattr(alignment, "STEP_CHARS", 50)
    assert [(r[:5], list(r[5]), list(r[6])) for r in alignment.Cuts(A, B).documents(texts)] == want


def test_components_by_doubling():
    """Against sets of common ends, on random token ends."""
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 60)
        a, b = (np.array(sorted({*rng.sample(range(1, n + 1), rng.randrange(0, n)), n})) for _ in range(2))
        cuts = sorted(set(a.tolist()) & set(b.tolist()))
        ga, gb = alignment.components(a, b)
        assert ga.tolist() == np.searchsorted(cuts, a).tolist() and gb.tolist() == np.searchsorted(cuts, b).tolist()


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([("x y", 5, 6, 7, "r")], "text string, nth int, pairs int, n_a int, row string")
    out = alignment.align_corpus(df, A, B)
    assert out.columns == ["text", "nth", "row", *COLUMNS[:6], "groups_sha256"]
    assert out.first()["nth"] == 5 and out.first()["n_groups"] == 2


