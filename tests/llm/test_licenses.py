import re

from brute import words

from dimwright.llm import licenses as L


def plain(text):
    """The scan in plain Python: base places and surviving detections."""
    w = words(text)
    joined = " ".join(w)

    def places(pattern):
        return [(joined[:m.start()].count(" "), m.group().count(" ") + 1) for m in re.finditer(L._bounded(pattern), joined)]

    base = [(s, n, label) for phrase, label in L.BASE.items() for s, n in places(phrase)]
    hits = sorted((s, -(s + n), r.priority, i, r.label, r.weight) for i, r in enumerate(L.rules()) if r.keyword in w
                  for s, n in places(r.pattern))
    kept = []
    for k, h in enumerate(hits):
        if not any(g[0] <= h[0] and -g[1] >= -h[1] and g[2] <= h[2] for g in hits[:k]):
            kept.append(h)
    return len(w), sorted(base), [(s, -b, p, label, weight) for s, b, p, _, label, weight in kept]


CASES = [
    None, "", " ", "Licensed under the Apache License, Version 2.0 (the License)", "MIT License. mit license, MIT licence",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
    "as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "SPDX-License-Identifier: GPL-2.0-or-later", "spdx-license-identifier: MIT AND apache license", "CC BY-SA 4.0 and CC-BY 3.0",
    "Creative Commons Attribution-ShareAlike 4.0 International", "general public license " * 400, "amit license mit licenses éMIT license",
    "Copyright (c) 2019 2020 X. All rights reserved. BSD 3-Clause", "gplv3 GPL v2 LGPL 2.1 lgplv2.1", "no such thing here", "mit",
    "été " * 3000 + "the MIT license", "İ mİt license MIT LICENSE", "x" * 5000,
]


def test_against_plain_scan(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string").selectExpr("doc_id", "text", "1 as base", "'x' as labels")
    for r in L.scan_licenses(df).collect():
        n, base, found = plain(CASES[r["doc_id"]])
        assert r["n_words"] == n, CASES[r["doc_id"]]
        assert sorted(map(tuple, r["base"])) == base
        assert [tuple(d) for d in r["detections"]] == found, CASES[r["doc_id"]]
    labels = {r["doc_id"]: [d["label"] for d in r["detections"]] for r in L.scan_licenses(df).collect()}
    assert labels[3] == ["apache-2.0"] and labels[6] == ["gpl-2.0-or-later"] and labels[9] == ["cc-by-sa-4.0"]
    assert "gpl-2.0-or-later" in labels[5] and "gpl-2.0" not in labels[5]


def test_rules_are_sound():
    known = L.rules()
    assert len(known) > 200
    for r in known:
        re.compile(r.pattern)
        assert re.fullmatch("[a-z0-9]+", r.keyword) and 0 <= r.priority <= 3 and 0 < r.weight <= 1
        assert re.search(rf"(?<![a-z0-9]){r.keyword}", r.pattern), r


def test_query(spark):
    import duckdb
    path = "/root/testdata/sf0.01"
    docs = dict(duckdb.sql(f"select doc_id, text from '{path}/documents.parquet'").fetchall())
    got = L.op3_license_scan(spark, path).collect()
    assert len(got) == len(docs)
    for r in got:
        n, base, found = plain(docs[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (n, len(base))
        assert (r["first_word"], r["last_word"]) == ((min(base)[0], max(b[0] for b in base)) if base else (None, None))
        assert r["base_labels"] == ",".join(sorted({b[2] for b in base}))
        assert r["labels"] == ",".join(sorted({b[2] for b in base} | {d[3] for d in found}))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(base or found)


def test_keywords_hide_no_match(spark):
    """All rules on all texts, without the keyword gate."""
    cases = CASES + ["the Beerware License", "beer ware licence", "Expat License", "the MIT Expat license", "expat expat license"]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for r in L.scan_licenses(df).collect():
        joined = " ".join(words(cases[r["doc_id"]]))
        hits = sorted((joined[:m.start()].count(" "), -(joined[:m.start()].count(" ") + m.group().count(" ") + 1), x.priority, i, x.label)
                      for i, x in enumerate(L.rules()) for m in re.finditer(L._bounded(x.pattern), joined))
        kept = [h for k, h in enumerate(hits) if not any(g[0] <= h[0] and g[1] <= h[1] and g[2] <= h[2] for g in hits[:k])]
        assert [(d["start"], d["label"]) for d in r["detections"]] == [(h[0], h[4]) for h in kept], cases[r["doc_id"]]
