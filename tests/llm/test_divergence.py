import random
import re
from collections import Counter, defaultdict

import pytest

from dimwright.llm import divergence


def terms_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)


def plain(rows, min_docs, top):
    """The report by the definition: every pair of sources compared on every kept term."""
    docs = [(lang or "", source or "", terms_of(text)) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, ts in here for t in set(ts))
        kept = sorted(t for t in seen if seen[t] >= min_docs)
        counts = defaultdict(Counter)
        for _, source, ts in here:
            counts[source].update(t for t in ts if seen[t] >= min_docs)
        whole = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // total for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(whole)
        for s in p:
            pairs = [(sum(abs(p[s][w] - p[t][w]) for w in kept), t) for t in p if t != s]
            own = [(p[s][w] - q[w], w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", own, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def run(spark, rows, min_docs=3, top=5):
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    out = divergence.audit_sources(df, min_docs=min_docs, top=top)
    return sorted(tuple(r) for r in out.collect())


def made_rows(seed, n=300):
    rng = random.Random(seed)
    words = [w for i in range(40) for w in (f"w{chr(97 + i % 26)}{chr(97 + i // 26)}", "Ünï" + chr(97 + i % 26))]
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < .4 else rng.choice(["a", "b", "c", "Zürich", None, ""])
        text = " ".join(rng.choice(words[:int(rng.paretovariate(.6)) + 1]) for _ in range(rng.randrange(30)))
        rows.append((rng.choice(["en", "en", "de", None]), source, rng.choice([text, text.upper(), text.replace(" ", "1"), None if rng.random() < .2 else text])))
    return rows + rows[:10] + [("xx", "only", "lone text"), ("yy", "p", None), ("yy", "q", "")]


@pytest.mark.parametrize("items,pairs", [(None, None), (7, 5)])
def test_equals_the_definition(spark, monkeypatch, items, pairs):
    """Also when every batch of the tree holds a few items only, so that most nodes are cut."""
    if items:
        monkeypatch.setattr(divergence, "TREE_ITEMS", items)
        monkeypatch.setattr(divergence, "TREE_PAIRS", pairs)
        monkeypatch.setattr(divergence, "FLUSH_TERMS", 10)
        monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    rows = made_rows(1)
    got, want = run(spark, rows), plain(rows, 3, 5)
    assert got == want
    assert {r[2] for r in got} == {"pair", "term"} and ("yy", "p", "pair", "q", 0, 1) in got and max(r[5] for r in got if r[2] == "term") == 5


def test_ties_go_by_bytes(spark):
    """Equal values: U+FFFD sorts before U+10000 in UTF-8."""
    rows = [("en", "s", "\U00010000 � z a")] * 3 + [("en", "t", "b")] * 3
    got = run(spark, rows)
    assert got == plain(rows, 3, 5)
    assert [r[3] for r in sorted((r for r in got if r[1] == "s" and r[2] == "term"), key=lambda r: r[5])] == ["a", "z", "�", "\U00010000"]


def test_many_sources_and_long_texts(spark):
    """Long rows of the tree: a term in each of 60 sources; counts beyond 32 bits times 10^9."""
    rows = [("en", f"s{i % 60:02}", "common " * (i % 7 + 1) + f"own{'x' * (i % 60)} " * (i % 3)) for i in range(360)]
    rows.append(("en", "s07", "word common " * 100_000))
    assert run(spark, rows) == plain(rows, 3, 5)


def test_empty_table_and_other_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([("en", "s", "t t", 1, 2)] * 3, "lang string, source string, text string, term int, n int")
    assert [tuple(r) for r in divergence.audit_sources(df, min_docs=3).collect()] == []  # p equals q, and there is no other source


def test_tree_merges_shared_paths(spark):
    """Terms with the same counts up to a source share the nodes up to it: their corrections are weighted, not repeated."""
    path = [(0, 10, 4), (1, 20, 6), (2, 9, 5)]
    rows = [("en", path, 5), ("en", path[:2], 2), ("en", [path[0], path[2]], 1)]
    df = spark.createDataFrame(rows, "lang string, path array<struct<place: long, p: long, zero: long>>, many long").coalesce(1)
    got = {(r.s, r.t): int(r.value) for r in divergence.tree_corrections(df.sortWithinPartitions("lang", "path")).collect()}
    fix = lambda a, b: abs(a[1] - b[1]) - abs(a[1] - b[2]) - abs(b[1] - a[2]) + abs(a[2] - b[2])
    assert got == {(0, 1): 7 * fix(path[0], path[1]), (0, 2): 6 * fix(path[0], path[2]), (1, 2): 5 * fix(path[1], path[2])}
