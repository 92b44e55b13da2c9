"""Personal data and secrets: base spans against plain regexes, added spans by example."""

import random

import pytest
from brute import BASE_PII, BASE_SECRETS, base_spans, digest

from dimwright.llm import pii, secret_scan

ODD = ["", None, "a@b", "a@b.c@d.ee x..y@z.-q.w", "1.2.3.4.5.6.7.8.9", "999.1.1.1.2.3.4.5", "0001.2.3.04", "+1", "+1 ((((( ",
       "+12 345 678 901", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "é" * 50 + "mail a@b.cc",
       "PassWord = 'abc123xyz'", "api_key:short", "apikey:  \"abcdef", "ſecret=abcdef1", "AKIA" + "A" * 16, "AKIAshort",
       "deadbeef" * 3, "deadbeef" * 3 + "G", "1" * 5000, "a" * 3000 + "@", "1." * 3000, "+1" * 2000]


def texts(n=400):
    rng = random.Random(5)
    parts = ["a", "Z", "0", "19", "255", ".", "@", "-", " ", "+", "(", ")", "é", "=", ":", "'", '"', "token", "SECRET",
             "AKIA", "deadbeef", "4111111111111111", "x.y", "\n"]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("text", texts())
def test_base_spans_match_the_patterns(text):
    got = [(c.kind, c.start, c.end) for c in pii.candidates(text) if c.base]
    assert got == base_spans(text, BASE_PII)
    got = [(k, s, e) for k, s, e, base in secret_scan.scan(text) if base]
    assert got == base_spans(text, BASE_SECRETS)


def test_queries_on_the_table(spark):
    import duckdb
    path = "/root/testdata/sf0.001"
    docs = dict(duckdb.sql(f"select doc_id, text from '{path}/documents.parquet'").fetchall())
    for query, kinds in ((pii.op2_personal_data, BASE_PII), (secret_scan.op5_secret_scan, BASE_SECRETS)):
        got = query(spark, path).collect()
        assert sorted(r["doc_id"] for r in got) == sorted(docs)
        for r in got:
            want = base_spans(docs[r["doc_id"]], kinds)
            assert r["base_sha256"] == digest(want)
            assert [r[f"n_{k}"] for k in kinds] == [sum(x[0] == k for x in want) for k in kinds]
            assert set(f"{k}:{s}:{e}" for k, s, e in want) <= set(filter(None, r["spans"].split(",")))


def test_entropy_spans_and_allow_list():
    key = "tQ7rP0xV9mZk3LwY8sBn2HcF6dJg4RaE"
    kinds = [(k, s, e) for k, s, e, _ in secret_scan.scan(f"the {key} is loose")]
    assert kinds == [("entropy", 4, 4 + len(key))]
    for fine in ("123e4567-e89b-12d3-a456-426614174000", "internationalizationandlocalization", "a-long-file-name-of-words",
                 "----------------------------------", "SAMPLEtQ7rP0xV9mZk3LwY8sBn2HcF6d"):
        assert secret_scan.scan(f"see {fine} here") == []
    assert secret_scan.mask(f"a {key} b password=hunter22 c") == "a <secret> b <secret> c"
    assert secret_scan.mask(None) is None and secret_scan.mask("") == ""


def test_incremental_entropy_equals_direct():
    import math
    rng = random.Random(2)
    for _ in range(50):
        t = "".join(rng.choice("abcdef0123456789XYZ+/") for _ in range(60))
        w = secret_scan.WINDOW
        covered = set()
        for i in range(len(t) - w + 1):
            part = t[i:i + w]
            counts = {c: part.count(c) for c in part}
            if -sum(c / w * math.log2(c / w) for c in counts.values()) >= secret_scan.window_class(counts) - 1e-12:
                covered |= set(range(i, i + w))
        assert covered == {p for s, e in secret_scan.entropy_spans(t) for p in range(s, e)}


def test_added_personal_data(spark):
    rows = [(i, f"call 555-01{i:02d} or (415) 555-01{i:02d} phone (212) 555-22{i:02d} now") for i in range(30)]
    rows += [(100 + i, f"ssn 123-45-{6000 + i} of Dr. Peter Smith") for i in range(30)] + [(200, None), (201, ""), (201, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "id")
    got = pii.find_personal_data(df.selectExpr("id", "text", "1 as personal_data", "id as kind"), "id").collect()
    assert len(got) == len(rows)
    kinds = {r["id"]: [s["kind"] for s in r["personal_data"]] for r in got}
    assert kinds[200] == [] and "local_phone" in kinds[3] and {"id_number", "person"} <= set(kinds[110])
    empty = pii.find_personal_data(df.limit(0), "id")
    assert empty.count() == 0


def test_reliabilities_follow_the_votes():
    cells = {"card|+++++|2": 500, "card|-+0++|2": 20, "card|--0-+|2": 300, "ip|+++++|1": 50, "ip|---++|1": 50}
    model = pii.fit_cells(cells)
    assert model["probability"]["card|+++++|2"] > 0.9 > 0.5 > model["probability"]["card|--0-+|2"]
    assert model["reliability"]["card.check"] > 0.9
    assert pii.fit_cells({}) == {"reliability": {}, "probability": {}}


def test_entropy_beside_patterns_and_samples():
    key = "tQ7rP0xV9mZk3LwY8sBn2HcF6dJg4RaEuT5oXi1C"
    long = "Qm4vZ8kT1xRb7NcY3wLs9HfJ2pGd6V" + "dummy" + "Ke5uAa0XoWi8ZtMq1rBn4SyCh7DlPg"
    for text, secret in ((f"AKIA{'Q7' * 8}/{key}", key), ("deadbeef" * 5 + "-" + key, key), (f"/sample/{key}", key), (f"see {long} .", long),
                         ("use k9Xf2LmQ8vRt4ZpW now", "k9Xf2LmQ8vRt4ZpW"), ("use 9f3a1c7e5b2d8064 now", "9f3a1c7e5b2d8064")):
        spans = [(s, e) for kind, s, e, _ in secret_scan.scan(text) if kind == "entropy"]
        at = text.index(secret)
        assert spans == [(at, at + len(secret))], text
        assert secret not in secret_scan.mask(text)
    for fine in ("a_name_of_a_variable", "getElementsByTagName", "1234567890123456", "2024/01/15/report1", "mytoken=abcdef12345"):
        assert not [x for x in secret_scan.scan(f"see {fine} here") if x[0] == "entropy"], fine


HARMLESS = """//cdn.example.org/assets/app-3f2a9c1b7d https://youtu.be/dQw4w9WgXcQ https://www.example.com/embed/dQw4w9WgXcQ
ThisIsAVeryLongCamelCaseIdentifierName2 getElementsByClassName AbstractSingletonProxyFactoryBean3 XMLHttpRequestUpload
sha512-q2eYw4x9k3pQm7r8T1vZs5u6N0bLcXfJhDgKaW+PoIiUyTrEeRtYuOpLkJhGfDsA== integrity=sha256-Qm4vZ8kT1xRb7NcY3wLs9HfJ2pGd6VKe5uAa0XoWi8Y=
/usr/local/lib/python3/dist-packages/numpy/core a_long_variable_name_v2 some-article-title-about-nothing-2024
2024-01-15/report-final-v3 src/main/java/com/example/App2 static/js/main.8d2f1c3b.chunk.js images/photo-1507525428034 node_modules/left-pad
NEW_MAX_CONNECTIONS_PER_HOST https://github.com/user/repository/issues/12345 en/articles/the-quick-brown-fox fonts/OpenSans-SemiBold
123e4567-e89b-12d3-a456-426614174000 -------------------------- ________________________ 20240115/20240116/20240117""".split()


def test_harmless_strings_are_left_alone():
    """Names, paths, links and checksums: none becomes a span, so none is cut out of a training text."""
    found = {t: x for t in HARMLESS if (x := [f for f in secret_scan.scan(f"see {t} here") if f[0] == "entropy"])}
    assert not found, found
    text = " ".join(HARMLESS)
    assert len(HARMLESS) == 25 and secret_scan.mask(text) == text


def test_random_keys_are_still_found():
    rng = random.Random(7)
    b62 = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for chars, size, least in ((b62, 20, .94), (b62, 32, .98), (b62, 40, .98), (b62 + "+/", 40, .97), (b62 + "-_", 43, .97), ("0123456789ABCDEF", 32, .9)):
        keys = ["".join(rng.choice(chars) for _ in range(size)) for _ in range(500)]
        hit = sum(any(k == "entropy" for k, *_ in secret_scan.scan(f"use {x} now")) for x in keys)
        print(len(chars), size, hit / 500)
        assert hit / 500 >= least, (len(chars), size, hit)


def test_secret_scan_of_odd_rows(spark):
    """Empty tables, null and repeated rows, clashing names, a very long text."""
    key = "tQ7rP0xV9mZk3LwY8sBn2HcF6dJg4RaEuT5oXi1C"
    schema = "text string, secrets string, kind int"
    df = spark.createDataFrame([(None, "a", 1), (None, "a", 1), ("", "b", 2), (f"{key} " + "plain words " * 50_000 + key, "c", 3)], schema)
    out = secret_scan.find_secrets(df)
    assert out.columns == ["text", "kind", "secrets"]
    assert sorted(len(r["secrets"]) for r in out.collect()) == [0, 0, 0, 2]
    assert secret_scan.find_secrets(df.limit(0)).count() == 0
