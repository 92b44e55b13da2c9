import hashlib
import random

from brute import words

from dimwright.llm import contamination as C


def plain(docs, items, window=10):
    wins = {}
    for name, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if w else ():
            wins.setdefault(tuple(w[i:i + n]), set()).add(str(name) if name is not None else "null")
    out = []
    for d, text in docs:
        w, hit, names = words(text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if (found := wins.get(tuple(w[i:i + n]))):
                    hit |= set(range(i, i + n))
                    names |= found
        out.append((d, len(w), len(hit), sorted(names)))
    return out


def made(seed=3):
    rng = random.Random(seed)
    vocab = ["The", "of", "é", "x1", "and", "Zeta", "42"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.randint(11, 25))) for i in range(12)] + [(50, "only three words"), (51, ""), (52, None), (None, say(12)),
                                                                  (60, "x"), (1, say(14))]
    docs = [(i, say(rng.randint(0, 40)) + ". " + rng.choice(items)[1 if rng.random() < 0.5 else 1].__str__()[:rng.randint(0, 90)]
             + " " + say(5)) for i in range(60)]
    docs += [(100, None), (101, ""), (101, ""), (102, (items[0][1] + " ") * 50), (103, "Only THREE, words")]
    return docs, items


def check(got, want):
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], sorted({m["item_id"] for m in r["matches"]})) for r in got)
    assert got == sorted(want)


def test_against_plain_search(spark, monkeypatch):
    docs, items = made()
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as matches", "1 as n_hit")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = plain(docs, items)
    assert any(w[2] for w in want) and any(not w[2] for w in want)
    check(C.find_contamination(d, b).collect(), want)
    monkeypatch.setattr(C, "SHARD_WORDS", 30)
    check(C.find_contamination(d, b).collect(), want)
    # a benchmark of many blocks gives the same
    monkeypatch.setattr(C, "BLOCK_WORDS", 40)
    check(C.find_contamination(d, b).collect(), want)


def test_longest_match_and_place(spark):
    item = " ".join(f"w{i}" for i in range(30))
    doc = "zz " + " ".join(f"w{i}" for i in range(3, 25)) + " zz " + " ".join(f"w{i}" for i in range(12))
    d = spark.createDataFrame([(1, doc)], "doc_id long, text string")
    b = spark.createDataFrame([(7, item)], "item_id long, text string")
    r = C.find_contamination(d, b).first()
    assert [tuple(m) for m in r["matches"]] == [("7", 1, 3, 22)]
    assert r["hit_runs"] == [[1, 23], [24, 36]] and r["n_hit"] == 34


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert C.find_contamination(d, b.limit(0)).first()["n_hit"] == 0
    assert C.find_contamination(d.limit(0), b).count() == 0


def test_query(spark):
    import duckdb
    path = "/root/testdata/sf0.001"
    rows = lambda t, c: duckdb.sql(f"select {c}, text from '{path}/{t}.parquet'").fetchall()
    want = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0)
            for d, n, h, i in plain(rows("documents", "doc_id"), rows("benchmark", "item_id"))]
    got = [tuple(r) for r in C.op4_decontamination(spark, path).collect()]
    assert sorted(got) == sorted(want)


def test_a_block_of_a_million_words_stays_small():
    """Arrays, not a dictionary of windows: what a worker holds of one block, and what is pickled to it."""
    import pickle
    rng = random.Random(1)
    vocabulary = [f"word{i}".encode() for i in range(50_000)]
    block = C.Block([(str(i), rng.choices(vocabulary, k=1000)) for i in range(C.BLOCK_WORDS // 1000)])
    held = sum(a.nbytes for arrays in block.arrays.values() for a in arrays)
    assert held < 70 << 20 and len(pickle.dumps(block, 5)) < 75 << 20
    assert len(block.arrays[10][1]) == C.BLOCK_WORDS // 1000 * 991
