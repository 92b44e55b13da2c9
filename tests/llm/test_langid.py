import zlib

import pytest

from dimwright.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    import duckdb
    docs = {r[0]: r[1:] for r in duckdb.sql(f"select doc_id, lang, text from '{SF}/documents.parquet'").fetchall()}
    got = langid.op10_language_id(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"] and docs[r["doc_id"]][0]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]][0] for r in held)
    assert right / len(held) >= 0.97, right / len(held)


def plain_vector(text, enc):
    import numpy as np
    t = "".join(c if c.isalpha() else " " for c in text.lower())
    t = f" {' '.join(t.split())} "
    out = np.zeros(enc.dimension)
    for a, b, c in zip(t, t[1:], t[2:]):
        out += np.roll(enc.vector(ord(a)), 2) * np.roll(enc.vector(ord(b)), 1) * enc.vector(ord(c))
    return out


@pytest.mark.parametrize("texts", [["Hello, world", "", "a", "123 ü!", "ab  cd"], ["İx", "日本語 テキスト"], ["", ""]])
def test_bundle_equals_plain_sum(texts):
    import numpy as np
    enc = langid.Encoder()
    vectors, has = enc.bundle(texts)
    for v, t, h in zip(vectors, texts, has):
        assert h == any(c.isalpha() for c in t)
        if h:
            assert np.allclose(v, plain_vector(t, enc))


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en", "x"), (2, "der hund und die katze", "de", "x"), (2, "der hund und die katze", "de", "x"),
            (3, None, "en", "x"), (4, "", None, "x"), (None, "12 34 !!", "en", "x"), (5, "the dog " * 40_000, None, "x")]
    df = spark.createDataFrame(rows, "id long, text string, lang string, score string")
    got = langid.predict(df, langid.train(df), keep=["id", "lang"]).collect()
    assert [r["lang_pred"] for r in got] == ["en", "de", "de", "und", "und", "und", "en"]
    assert langid.train(df.limit(0)) == {}
    assert {r["lang_pred"] for r in langid.predict(df, {}).collect()} == {"und"}
    # equal cosines: the first name
    p = langid.train(df)["en"]
    assert langid.predict(df.limit(1), {"zz": p, "aa": p}).first()["lang_pred"] == "aa"


def test_many_different_letters_stay_small(monkeypatch):
    """Half a million CJK letters have as many different trigrams: only the pairs that occur are counted."""
    import random
    import tracemalloc

    import numpy as np
    rng = random.Random(1)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(2000)) for _ in range(64)]
    enc = langid.Encoder(64)
    tracemalloc.start()
    enc.bundle(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
    few = ["the cat", "der hund und", "x"]
    want = langid.Encoder().bundle(few)[0]
    monkeypatch.setattr(langid, "DENSE_PAIRS", 0)
    assert np.array_equal(langid.Encoder().bundle(few)[0], want)


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "text string, lang_pred int, score int, lang string")
    out = langid.predict(df, {"en": [1.0] * langid.DIMENSION})
    assert out.columns == ["text", "lang", "lang_pred", "score"] and out.count() == 0
