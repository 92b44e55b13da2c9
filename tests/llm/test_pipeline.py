import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as P  # noqa: E402
import test_contamination  # noqa: E402
import test_minhash  # noqa: E402
import test_mixing  # noqa: E402
from brute import BASE_SECRETS, base_spans  # noqa: E402

from dimwright.llm import mixing, secret_scan  # noqa: E402


def plain(docs, items):
    """doc_id -> row after each stage, by plain code: [(after stage, rows)]."""
    out = []
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    out.append(docs)
    kept = {r[0] for r in test_minhash.plain([(d[0], d[1]) for d in docs], 5) if r[3]}
    docs = [d for d in docs if d[0] in kept]
    out.append(docs)
    hit = {r[0] for r in test_contamination.plain([(d[0], d[1]) for d in docs], items) if r[2]}
    docs = [d for d in docs if d[0] not in hit]
    out.append(docs)
    docs = [(d[0], m := secret_scan.mask(d[1]), d[2], d[3], d[4] if m == d[1] else len(m)) for d in docs]
    out.append(docs)
    mixed, _ = test_mixing.plain([d[:4] for d in docs], mixing.SHARE, mixing.EPOCHS, mixing.DOMAINS, mixing.WEIGHTS,
                                 mixing.DEFAULT_WEIGHT, mixing.SEED)
    out.append([r[:-1] for r in mixed if r[-1]])
    return out


def test_stages_and_run(spark):
    import duckdb
    path = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"select doc_id, text, lang, source, n_chars from '{path}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{path}/benchmark.parquet'").fetchall()
    want = plain(docs, items)
    assert len(docs) > len(want[1]) > len(want[2])
    rows = spark.read.parquet(f"{path}/documents.parquet")
    columns = rows.columns
    for (name, stage), expected in zip(P.STAGES, want):
        rows = stage(spark, rows, path)
        got = sorted((tuple(r) for r in rows.collect()), key=repr)
        assert got == sorted(expected, key=repr), name
        if name != "mix":
            assert rows.columns == columns
            rows = spark.createDataFrame(got, rows.schema)
    assert sorted((tuple(r) for r in P.run(spark, path).collect()), key=repr) == sorted(want[-1], key=repr)
    # no base secret is left in any text
    assert not any(base_spans(d[1], BASE_SECRETS) for d in want[3])


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, "en", "src0", 0), (2, "", "en", "src1", 0), (3, "12 34 !!", None, None, 8), (4, "one good text of words", None, None, 22),
            (4, "one good text of words", None, None, 22), (None, "another text that has no id", "en", None, 27),
            (7, "key password=hunter2hunter ok", "en", "src2", 29)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        docs = spark.createDataFrame(docs.collect(), schema)
    left = sorted((tuple(r) for r in docs.collect()), key=repr)
    assert [r[0] for r in left] == [4, 4, 7, None] and left[2][1:] == ("key <secret> ok", "en", "src2", 15)
    empty = spark.createDataFrame([], schema)
    for name, stage in P.STAGES:
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0


def test_near_dedup_decides_per_row(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = [" ".join(f"{t}{i}" for i in range(40)) for t in "abcdefg"]
    a, b, c, d, e, f, g = texts
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c), (None, c + " end"), (5, d), (4, e), (5, e), (6, f), (6, f), (8, g), (8, g + " end"),
            (None, ""), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
    got = sorted(((r["doc_id"], r["text"]) for r in P.near_dedup(spark, docs, "").collect()), key=repr)
    # one of the rows without an id that hold c; one of the texts of 8; rows equal in id and text are one document
    left = [r for r in got if r[1] not in (c, c + " end", g, g + " end")]
    assert left == sorted([(1, a), (None, b), (5, d), (4, e), (6, f), (6, f), (None, ""), (None, "")], key=repr)
    assert [r[0] for r in got if r not in left] == [8, None]


def test_only_the_last_folders_are_left(spark):
    import os as _os

    from dimwright.llm import common
    common.drop_saved(spark)
    out = P.run(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    left = [_os.path.basename(p).rsplit("-", 1)[0] for p in common.saved()]
    assert [n for n in left if n.startswith("pipeline-")] == ["pipeline-secrets"]
    assert all(n.startswith(("pipeline-secrets", "mix-")) for n in left)
    folder = lambda p: p.removeprefix("file:")
    paths = common.saved()
    assert all(_os.path.exists(folder(p)) for p in paths)
    assert len(out.collect()) == len(rows) > 0
    common.drop_saved(spark)
    assert common.saved() == [] and not any(_os.path.exists(folder(p)) for p in paths)
