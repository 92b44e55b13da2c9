import hashlib
import random
import re

import pytest

from dimwright.llm import mixing as M


def fill(children, budget):
    """(name, weight, cap) -> quota, by filling the scarcest child first."""
    quota, left = {}, sorted(children, key=lambda c: (c[2] / c[1] if c[1] else -1.0, c[0]))
    while left:
        name, weight, cap = left[0]
        if cap * sum(c[1] for c in left) <= weight * budget:
            quota[name] = cap
            budget -= cap
            left.pop(0)
        else:
            break
    total = sum(c[1] for c in left)
    parts = {n: w * budget // total for n, w, _ in left}
    odd = budget - sum(parts.values())
    for i, n in enumerate(sorted(parts)):
        quota[n] = parts[n] + (i < odd)
    return quota


def plain(docs, share, epochs, domains, weights, defaults, seed):
    rows, leaves = [], {}
    of = {s: d for d, ss in domains.items() for s in ss}
    for d, text, lang, source in docs:
        lang, source = lang or "und", source or "unknown"
        n = len(re.findall(M.TOKEN, text or ""))
        leaf = (of.get(source, "other"), lang, source)
        rows.append((d, leaf, n))
        leaves[leaf] = leaves.get(leaf, 0) + n
    w = lambda lv, v: weights.get(lv, {}).get(v, defaults[lv])
    cap = {f: t * epochs if w("domain", f[0]) and w("lang", f[1]) and w("source", f[2]) else 0 for f, t in leaves.items()}
    under = lambda p: sum(c for f, c in cap.items() if f[:len(p)] == p)
    quota = {(): min(sum(leaves.values()) * share[0] // share[1], sum(cap.values()))}
    for depth, lv in enumerate(M.LEVELS):
        for parent in {f[:depth] for f in leaves}:
            kids = {f[:depth + 1] for f in leaves if f[:depth] == parent}
            for name, q in fill([(k[-1], w(lv, k[-1]), under(k)) for k in kids], quota[parent]).items():
                quota[(*parent, name)] = q
    out = []
    for leaf, total in leaves.items():
        whole = quota[leaf] // total if total else 0
        rest = quota[leaf] - whole * total
        mine = sorted((hashlib.md5(f"{seed}:{whole}:{'null' if d is None else d}".encode()).hexdigest(), str(d), n, d)
                      for d, f, n in rows if f == leaf)
        for _, _, n, d in mine:
            extra = max(0, min(n, rest))
            rest -= extra
            out.append((d, *leaf, n, whole + (extra > 0) if n else 0, whole * n + extra, whole * n + extra > 0))
    return sorted(out, key=repr), quota


def made(seed=1, n=400):
    rng = random.Random(seed)
    docs = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 40))), rng.choice(["en", "en", "de", "fr", None]),
             rng.choice(["hot"] * 8 + ["s1", "s2", "s3", "x9", None])) for i in range(n)]
    return docs + [(n, None, "en", "hot"), (n + 1, "", "zz", "empty"), (None, "a b c", "en", "s1"), (5, "q " * 300, "en", "hot"),
                   (5, "q " * 300, "en", "hot")]


CASES = [dict(share=(3, 5), epochs=2), dict(share=(1, 50), epochs=1), dict(share=(5, 1), epochs=3), dict(share=(0, 1), epochs=1)]


@pytest.mark.parametrize("case", CASES)
def test_against_plain(spark, case):
    docs = made()
    setup = dict(domains={"a": ["hot", "s1"], "b": ["s2"]}, weights={"domain": {"a": 7, "b": 3}, "lang": {"en": 9, "fr": 0}, "source": {"hot": 2}},
                 defaults={"domain": 1, "lang": 2, "source": 1}, seed="t", **case)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as domain", "'x' as leaf", "2 as n_tokens")
    want, quota = plain(docs, **setup)
    got = sorted((tuple(r) for r in M.mix_sources(df, **setup).collect()), key=repr)
    assert got == want
    # the budget is met to the token
    assert sum(r[6] for r in got) == quota[()]
    assert all(q == sum(r[6] for r in got if r[1:4] == f) for f, q in quota.items() if len(f) == 3)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert M.mix_sources(df).count() == 0
    df = spark.createDataFrame([(1, None, None, None)], "doc_id long, text string, lang string, source string")
    assert tuple(M.mix_sources(df).first()) == (1, "other", "und", "unknown", 0, 0, 0, False)


def test_shortage_goes_to_siblings_first():
    # the poor source's share goes to its sibling, not to the other language
    docs = [(i, "t " * 100, "en", "poor") for i in range(1)] + [(10 + i, "t " * 100, "en", "rich") for i in range(9)]
    docs += [(100 + i, "t " * 100, "de", "other") for i in range(10)]
    _, quota = plain(docs, (1, 2), 1, {}, {}, {"domain": 1, "lang": 1, "source": 1}, "s")
    assert quota[("other", "en")] == quota[("other", "de")] == 500
    assert quota[("other", "en", "poor")] == 100 and quota[("other", "en", "rich")] == 400


def test_a_third_of_all_rows_without_an_id(spark, monkeypatch):
    """They share one place in the order: the cut lies among them, and they are ordered as one class per length."""
    rng = random.Random(4)
    docs = [(None if i % 3 == 0 else i, "w " * rng.choice([3, 3, 5, 8]), "en", "hot") for i in range(9000)]
    setup = dict(domains={}, weights={}, defaults={"domain": 1, "lang": 1, "source": 1}, epochs=1)
    seen = []
    real = M.cut_classes

    def watch(rows, names):
        out = real(rows, names)
        seen.append((rows.count(), rows.select("leaf", "key", *names).distinct().count(), out.count()))
        return out

    monkeypatch.setattr(M, "cut_classes", watch)
    monkeypatch.setattr(M, "PIECE_ROWS", 100)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    # the place of the missing ids in the leaf depends on the seed: take shares just below and above it
    place = sorted([(hashlib.md5(f"t:0:{'null' if d is None else d}".encode()).hexdigest(), d) for d, *_ in docs], key=lambda x: x[0])
    first = next(i for i, (_, d) in enumerate(place) if d is None)
    for at in (first + 1500, first + 10):
        share = (at, len(docs))
        want, quota = plain(docs, seed="t", share=share, **setup)
        got = sorted((tuple(r) for r in M.mix_sources(df, seed="t", share=share, **setup).collect()), key=repr)
        assert got == want and sum(r[6] for r in got) == quota[()]
    assert max(rows for rows, _, _ in seen) >= 3000  # the cut was among them
    assert max(classes for _, classes, _ in seen) <= 10
    assert all(rows == out for rows, _, out in seen)
