import random
import re

import numpy as np
import pytest
from brute import components

from dimwright.llm import minhash as M
from dimwright.llm.graph import connected_components


def shingles(text, width):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def plain(docs, width, num=80, den=100):
    """doc_id -> (set size, component) by comparing every pair that shares a shingle."""
    sets = [(d, shingles(t, width)) for d, t in docs]
    where = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    links, n = [], len(sets)
    for i in range(n):
        common = {}
        for x in sets[i][1]:
            for j in where[x]:
                if j > i:
                    common[j] = common.get(j, 0) + 1
        links += [(sets[i][0], sets[j][0]) for j, c in common.items()
                  if den * c >= num * (len(sets[i][1]) + len(sets[j][1]) - c)]
    comp = components([d for d, _ in sets], links)
    return sorted((d, len(s), comp[d], comp[d] == d) for d, s in sets)


def family(seed=1):
    """Copies, near copies, chains, unrelated and odd texts."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    docs, n = [], 0
    for size, changes in ((1, 0), (30, 0), (40, 2), (40, 8), (25, 14), (3, 1)) * 3:
        base = [rng.choice(vocab) for _ in range(rng.choice((8, 60, 150)))]
        for _ in range(size):
            w = list(base)
            for _ in range(changes):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            docs.append((n, " ".join(w).replace("w1", "W1") if rng.random() < 0.3 else "  ".join(w)))
            n += 1
    # a chain: each text shifts the one before it a little
    words = [f"c{i}" for i in range(400)]
    for i in range(0, 120, 4):
        docs.append((n, " ".join(words[i:i + 150])))
        n += 1
    return docs + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "one two"), (n + 6, " "),
                   (n + 7, "x " * 30_000), (n + 8, "x x")]


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_all_pairs(spark, width):
    docs = family()
    random.Random(0).shuffle(docs)
    df = spark.createDataFrame(docs, "id long, text string").selectExpr("id", "text", "'x' as component_id", "1 as node").repartition(5)
    got = M.near_duplicates(df, "id", width=width)
    assert sorted(tuple(r) for r in got.collect()) == plain(docs, width)


def test_query(spark):
    import duckdb
    path = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"select doc_id, text from '{path}/documents.parquet'").fetchall()
    assert sorted(tuple(r) for r in M.op9_near_duplicates(spark, path).collect()) == plain(docs, 2)


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "q r s t u v"), (2, None)],
                               "doc_id long, text string")
    got = sorted((tuple(r) for r in M.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 2, None, True), (2, 0, 2, True)], key=repr)
    assert M.near_duplicates(df.limit(0)).count() == 0


def one_by_one(elements, slots):
    """SuperMinHash as defined, element after element."""
    sig = np.full(slots, np.inf)
    for x in elements:
        p = list(range(slots))
        for j in range(slots):
            draw = M.mix(np.array([x + np.uint64((M._GOLD * (2 * j + 1)) & 0xFFFFFFFFFFFFFFFF)]))
            k = j + int((M.mix(draw)[0] >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32))
            p[j], p[k] = p[k], p[j]
            sig[p[j]] = min(sig[p[j]], j + float(draw[0] >> np.uint64(11)) * 2.0 ** -53)
    return sig


def test_signature_equals_the_definition(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 2 ** 63, n, np.uint64) for n in (0, 1, 2, 30, 200)]
    monkeypatch.setattr(M, "STEP_ELEMENTS", 50)
    got = M.signatures(sets, 24)
    for s, g in zip(sets, got):
        with np.errstate(over="ignore"):
            assert np.array_equal(one_by_one(s, 24), g)


def test_estimate():
    rng = np.random.default_rng(7)
    a = rng.integers(0, 2 ** 63, 300, np.uint64)
    b = np.concatenate([a[:270], rng.integers(0, 2 ** 63, 30, np.uint64)])
    s = M.signatures([a, b], 192)
    assert abs((s[0] == s[1]).mean() - 270 / 330) < 0.1


def test_connected_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)] + [(7, None)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    links = [(a, b) for a, b in links if b is not None and a != b]
    assert got == components({x for e in links for x in e}, links)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_are_made_again_once(spark, monkeypatch):
    """Null ids and repeated rows: one text per set reaches the Python step that makes the sets again."""
    base = " ".join(f"w{i}" for i in range(60))
    docs = [(None, f"{base} x{i}") for i in range(30)] + [(5, f"{base} y")] * 20
    made, add = [], M.add_columns
    monkeypatch.setattr(M, "add_columns", lambda df, inputs, fields, *a, **k: (made.append(df.count()) if fields is M.MEMBERS else None)
                        or add(df, inputs, fields, *a, **k))
    got = M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert made == [31] and {r["component_id"] for r in got} == {5} and sum(r["kept"] for r in got) == 20
