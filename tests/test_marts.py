"""Marts kept from pairs: changes against the mart of all rows."""

import random

from pyspark.sql import functions as F

from dimwright.operators import marts

SPEC = marts.MartSpec(name="m", fact="f", entity="k", measure="x", groups=(("g", "g"), ("h", "upper(h)")), where="ok")
SCHEMA = "k int, g int, h string, x double, ok boolean"


def plain(rows):
    groups = {}
    for k, g, h, x, ok in rows:
        if ok:
            e, xs, n = groups.setdefault((g, None if h is None else h.upper()), (set(), [], [0]))
            n[0] += 1
            if k is not None:
                e.add(k)
            if x is not None:
                xs.append(round(x * 100))
    return {key: (len(e), n[0], sum(xs) / 100.0 if xs else None) for key, (e, xs, n) in groups.items()}


def result(groups):
    return {(r["g"], r["h"]): (r["entity_count"], r["row_count"], r["total_amount"]) for r in marts.served(groups).collect()}


def some_rows(rng, n, keys):
    return [(rng.choice(keys), rng.choice([0, 0, 0, 1, None]), rng.choice(["a", "A", "b", None]),
             rng.choice([None, round(rng.uniform(-50, 50), 2)]), rng.choice([True, True, False, None])) for _ in range(n)]


def test_changes_add_up_to_the_whole(spark):
    rng = random.Random(5)
    rows = some_rows(rng, 300, [*range(20), None])
    stored = marts.group_change(None, marts.pairs(spark.createDataFrame(rows, SCHEMA), SPEC), SPEC)
    assert result(stored) == plain(rows)
    for step in range(3):
        touched = {None, *rng.sample(range(25), 6)}
        old = [r for r in rows if r[0] in touched]
        new = some_rows(rng, 0 if step == 2 else 80, sorted(k for k in touched if k is not None) + [None])
        before, after = (marts.pairs(spark.createDataFrame(x, SCHEMA), SPEC) for x in (old, new))
        stored = marts.merge_groups(stored, marts.group_change(before, after, SPEC), SPEC)
        rows = [r for r in rows if r[0] not in touched] + new
        assert result(stored) == plain(rows)


def test_nothing_changes_nothing_and_empty_groups_go(spark):
    rows = [(1, 1, "a", 2.0, True), (1, 1, "a", 2.0, True), (2, 1, "a", None, True)]
    p = marts.pairs(spark.createDataFrame(rows, SCHEMA), SPEC)
    assert marts.group_change(p, p, SPEC).count() == 0
    empty = marts.pairs(spark.createDataFrame([], SCHEMA), SPEC)
    stored = marts.group_change(None, p, SPEC)
    assert marts.served(stored).first().asDict() == {"g": 1, "h": "A", "entity_count": 2, "row_count": 3, "avg_amount": 2.0, "total_amount": 4.0}
    assert marts.merge_groups(stored, marts.group_change(p, empty, SPEC), SPEC).count() == 0
    assert marts.group_change(None, empty, SPEC).agg(F.count("*")).first()[0] == 0
