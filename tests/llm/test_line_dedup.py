import hashlib
import random

import pytest

from dimwright.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"


def plain(rows, min_chars=20, min_docs=3):
    """(id, n_lines, n_dropped, text) of each row, by the definition."""
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))
    split = [(i, (t or "").split("\n")) for i, t in rows]
    holders = {}
    for i, lines in split:
        for k in map(key, lines):
            if len(k) >= min_chars:
                holders.setdefault(k, set()).add(i)
    last = {k: max(ids, key=lambda i: (i is not None, i)) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, lines in split:
        kept = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return [tuple(r) for r in line_dedup.drop_frequent_lines(df, **kw).select("doc_id", "n_lines", "n_dropped", "text").collect()]


def same(a, b):
    return sorted(a, key=repr) == sorted(b, key=repr)


def made_rows():
    rng = random.Random(3)
    common = ["All rights reserved by the owner.", "Subscribe to our NEWS letter today", "ÄÖÜ äöü straße überall gleich", "x" * 20, "y" * 19]
    rows = []
    for i in range(200):
        lines = [rng.choice(common) if rng.random() < .3 else f"line {rng.randrange(400)} of some longer text" for _ in range(rng.randrange(8))]
        lines = [rng.choice(["", " ", "\t", "\r"]) + (x.upper() if rng.random() < .2 and x.isascii() else x) + rng.choice(["", "  ", "\r"]) for x in lines]
        rows.append((rng.choice([i, i, i, i // 2, None]), "\n".join(lines) or None))
    return rows + rows[:20]


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_KEYS, 0])
def test_equals_the_definition(spark, limit):
    """Also with repeated rows, shared and null ids, and with the frequent lines joined by a shuffle."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if not limit:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = made_rows()
        got = run(spark, rows, broadcast_keys=limit)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert same(got, plain(rows)) and sum(r[2] for r in got) > 50


def test_odd_texts(spark):
    line = "The same long enough line"
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, line), (5, f" {line.upper()}\t"), (6, f"{line}\nown\n{line}"), (7, line[:19]), (8, line[:19]), (9, line[:19]),
            (10, "\n".join(f"{line} {i}" for i in range(30_000))), (11, "\n".join(f"{line} {i}" for i in range(0, 30_000, 2))),
            (12, "\n".join(f"{line} {i}" for i in range(0, 30_000, 3))), (13, "z" * 500_000), (14, "z" * 500_000), (15, "z" * 500_000)]
    got = run(spark, rows)
    assert same(got, plain(rows))
    assert {r[0]: r[2] for r in got}[6] == 0 and {r[0]: r[2] for r in got}[13] == 1


def test_one_line_in_most_documents(spark):
    rows = [(i, f"A line that everyone repeats\nown text number {i} of this") for i in range(3000)]
    got = run(spark, rows)
    assert sum(r[2] for r in got) == 2999 and [r[0] for r in got if not r[2]] == [2999]


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(i, "some line that is long enough", 7, "a", "b", i) for i in range(3)],
                               "doc_id int, text string, n_lines int, h1 string, row string, at int")
    out = line_dedup.drop_frequent_lines(df)
    assert out.columns == ["doc_id", "text", "h1", "row", "at", "n_lines", "n_dropped"]
    assert sorted((r.doc_id, r.text, r.h1, r.row, r["at"], r.n_dropped) for r in out.collect()) == [
        (0, "", "a", "b", 0, 1), (1, "", "a", "b", 1, 1), (2, "some line that is long enough", "a", "b", 2, 0)]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_no_python_on_the_way(spark):
    out = line_dedup.op12_line_dedup(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    want = {(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain(texts.items())}
    assert {tuple(r) for r in out.collect()} == want
