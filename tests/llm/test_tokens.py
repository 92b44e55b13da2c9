import random

import public_tokenizers
import pytest

from dimwright.llm import tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def machine():
    return tokens.TokenTransducer(MODEL)


def made(n=1500):
    rng = random.Random(8)
    letters = " \n\t aaaeeetthhi.,;-—éß①日本▁x0 19<>\x00İſ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(n)]
    return texts + ["", " ", "\n", "   x", "a" * 3000, " " * 777, "the" * 500, "<s> </s> <0x0A> <unk>", "é" * 400, "a b " * 30_000]


def test_counts_equal_the_library(library, machine):
    texts = made()
    want = [len(x) for x in library.encode(texts)]
    assert machine.count_many(texts) == want
    assert [machine.count(t) for t in texts] == want


def test_chunk_maps_compose_in_any_grouping(machine):
    rng = random.Random(3)
    for text in made(120):
        whole = machine.count(text)
        for size in (1, 5, 40):
            assert machine.count(text, size) == whole
        if not text:
            continue
        # uneven chunks, composed from the right
        escaped, maps = machine.prefix + text.replace(" ", tokens.SPACE), []
        at = 0
        while at < len(escaped):
            step = rng.randint(1, 30)
            maps.append(machine.chunk_map(escaped[at:at + step]))
            at += step
        if len(maps) > 400:
            continue
        done = maps[-1]
        for m in reversed(maps[:-1]):
            done = machine.compose(m, done)
        assert machine.count_escaped(done.head) + done.inner + machine.count_escaped(done.tail or "") == whole


def test_small_tables_of_transitions(library, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_ARCS", 20)
    monkeypatch.setattr(tokens, "STEP_CHARS", 500)
    monkeypatch.setattr(tokens, "MAX_ARC_CHARS", 5)
    t = tokens.TokenTransducer(MODEL)
    texts = made(200)
    assert t.count_many(texts) == [len(x) for x in library.encode(texts)]


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        tokens.TokenTransducer(str(tmp_path / "none.model"))


def test_query(spark, library):
    import duckdb
    path = "/root/testdata/sf0.01"
    docs = dict(duckdb.sql(f"select doc_id, text from '{path}/documents.parquet'").fetchall())
    want = dict(zip(docs, (len(x) for x in library.encode([t or "" for t in docs.values()]))))
    got = tokens.op6_token_counts(spark, path).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["n_tokens"] == want[r["doc_id"]] and r["over_limit"] == (r["n_tokens"] > 4096)
        assert r["n_bytes"] == len((docs[r["doc_id"]] or "").encode())


def test_nulls_repeats_and_clashing_names(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "a b"), (2, "")], "id long, text string").selectExpr("*", "9 as n_tokens", "'x' as over_limit")
    got = sorted((tuple(r) for r in tokens.count_tokens(df, MODEL, "id", limit=1).collect()), key=repr)
    assert got == sorted([(1, 0, 0, False), (1, 0, 0, False), (None, 3, 2, True), (2, 0, 0, False)], key=repr)
    assert tokens.count_tokens(df.limit(0), MODEL, "id").count() == 0
