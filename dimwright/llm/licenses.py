"""License scan by ordered signature rules, in DataFrame functions only.

A rule is a regular expression over the words of a text (lower-cased, joined by one space), with a
keyword, a priority and a weight.  Only those rules run on a text whose keyword is among its words; most
texts meet none.  Every match becomes an interval of
words.  An interval that lies within another of the same or a better priority is suppressed, so
``gnu general public license version 2 or any later version`` gives one label, not three.

Words are runs of letters, digits and non-ASCII characters.  The base phrases are found apart from the
rules and always stay.  Null and empty texts have no words.  Equal intervals: better priority,
then the earlier rule.  The score is the largest weight of a detection (0 without any).  Repeated rows
give repeated results; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.llm.common import table

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: phrase -> label, whatever the other rules say
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
BASE_WEIGHT = 0.6


class Rule(NamedTuple):
    label: str
    keyword: str  # a word of every match
    priority: int  # 0 is best: tag, 1: text, 2: name with version, 3: name
    weight: float
    pattern: str


TAG, TEXT, VERSIONED, NAME = 0, 1, 2, 3
_WEIGHT = {TAG: 1.0, TEXT: 0.95, VERSIONED: 0.85, NAME: 0.6}

#: text passages and names, by hand: (label, keyword, priority, words)
_BY_HAND = [
    ("mit", "permission", TEXT, r"permission is hereby granted free of charge to any person obtaining a copy of this software"
     r"(?: and associated documentation files)?"),
    ("mit", "software", TEXT, r"the software is provided as is without warranty of any kind express or implied"),
    ("mit", "mit", VERSIONED, r"(?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?mit(?: licen[cs]e)?"),
    ("mit", "mit", NAME, r"(?:the )?mit(?: expat)? licen[cs]e"), ("mit", "expat", NAME, r"(?:the )?expat(?: expat)? licen[cs]e"),
    ("mit-0", "mit", VERSIONED, r"mit no attribution(?: licen[cs]e)?"),
    ("x11", "x11", NAME, r"x11 licen[cs]e"),
    ("isc", "isc", NAME, r"(?:the )?isc licen[cs]e"),
    ("isc", "permission", TEXT, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "bsd", NAME, r"(?:the )?bsd(?: style)? licen[cs]e"),
    ("bsd-2-clause", "bsd", VERSIONED, r"(?:bsd (?:2|two) clause|(?:simplified|freebsd) bsd)(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", VERSIONED, r"(?:bsd (?:3|three) clause|(?:new|revised|modified) bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", VERSIONED, r"(?:bsd (?:4|four) clause|original bsd)(?: licen[cs]e)?"),
    ("0bsd", "bsd", VERSIONED, r"(?:zero clause bsd|bsd zero clause)(?: licen[cs]e)?"),
    ("bsd", "redistribution", TEXT, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", TEXT, r"neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse or promote"),
    ("bsd-4-clause", "advertising", TEXT, r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "apache", TEXT, r"licensed under the apache license version 2 0"),
    ("apache", "apache", NAME, r"(?:the )?apache(?: software)? licen[cs]e"),
    ("apache-1.1", "apache", TEXT, r"this product includes software developed by the apache (?:software foundation|group)"),
    ("gpl", "gpl", NAME, r"(?:gnu )?gpl"), ("gpl", "gnu", NAME, r"gnu general public licen[cs]e"),
    ("gpl", "general", NAME, r"general public licen[cs]e"), ("lgpl", "lgpl", NAME, r"(?:gnu )?lgpl"),
    ("lgpl", "lesser", NAME, r"(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl", "library", NAME, r"(?:gnu )?library general public licen[cs]e"),
    ("agpl", "agpl", NAME, r"(?:gnu )?agpl"), ("agpl", "affero", NAME, r"(?:gnu )?affero general public licen[cs]e"),
    ("gpl", "redistribute", TEXT, r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "redistribute", TEXT, r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e"),
    ("agpl", "redistribute", TEXT, r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e"),
    ("gfdl", "documentation", NAME, r"(?:gnu )?free documentation licen[cs]e"),
    ("mpl", "mozilla", NAME, r"mozilla public licen[cs]e"),
    ("mpl-2.0", "mozilla", TEXT, r"subject to the terms of the mozilla public license v 2 0"),
    ("epl", "eclipse", NAME, r"eclipse public licen[cs]e"), ("cddl", "cddl", NAME, r"cddl"),
    ("cddl", "common", NAME, r"common development and distribution licen[cs]e"),
    ("cpl", "common", NAME, r"common public licen[cs]e"), ("eupl", "union", NAME, r"european union public licen[cs]e"),
    ("artistic", "artistic", NAME, r"(?:the )?artistic licen[cs]e"), ("perl", "perl", TEXT, r"same terms as perl itself"),
    ("zlib", "zlib", NAME, r"zlib(?: libpng)? licen[cs]e"),
    ("zlib", "arising", TEXT, r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost", "boost", NAME, r"boost software licen[cs]e"), ("bsl-1.0", "boost", TEXT, r"distributed under the boost software license version 1 0"),
    ("unlicense", "unlicense", NAME, r"(?:the )?unlicense"),
    ("unlicense", "unencumbered", TEXT, r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "wtfpl", NAME, r"wtfpl"), ("public-domain", "public", NAME, r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("cc0-1.0", "cc0", VERSIONED, r"cc0(?: 1 0)?(?: universal)?"), ("cc", "creative", NAME, r"creative commons(?: licen[cs]e)?"),
    ("cc0-1.0", "waived", TEXT, r"waived all copyright and related or neighboring rights"),
    ("ofl", "font", NAME, r"(?:sil )?open font licen[cs]e"), ("odbl", "database", NAME, r"open (?:data commons open )?database licen[cs]e"),
    ("pddl", "dedication", NAME, r"public domain dedication and licen[cs]e"), ("ncsa", "ncsa", NAME, r"(?:university of illinois )?ncsa(?: open source)? licen[cs]e"),
    ("psf", "python", NAME, r"python(?: software foundation)? licen[cs]e"), ("php", "php", NAME, r"php licen[cs]e"),
    ("ruby", "ruby", NAME, r"ruby licen[cs]e"), ("openssl", "openssl", NAME, r"openssl licen[cs]e"),
    ("openssl", "openssl", TEXT, r"this product includes software developed by the openssl project"),
    ("ms-pl", "microsoft", NAME, r"microsoft public licen[cs]e"), ("ms-rl", "microsoft", NAME, r"microsoft reciprocal licen[cs]e"),
    ("w3c", "w3c", NAME, r"w3c(?: software)?(?: notice and)? licen[cs]e"), ("upl-1.0", "permissive", NAME, r"universal permissive licen[cs]e"),
    ("bsl-1.1", "business", NAME, r"business source licen[cs]e"), ("sspl-1.0", "server", NAME, r"server side public licen[cs]e"),
    ("elastic-2.0", "elastic", NAME, r"elastic licen[cs]e(?: 2 0)?"), ("commons-clause", "clause", NAME, r"commons clause(?: licen[cs]e)?"),
    ("beerware", "beer", NAME, r"(?:the )?beer ware licen[cs]e"),
    ("beerware", "beerware", NAME, r"(?:the )?beerware licen[cs]e"), ("postgresql", "postgresql", NAME, r"postgresql licen[cs]e"),
    ("ijg", "jpeg", TEXT, r"this software is based in part on the work of the independent jpeg group"),
    ("curl", "curl", NAME, r"curl licen[cs]e"), ("libtiff", "libtiff", NAME, r"libtiff licen[cs]e"),
    ("json", "evil", TEXT, r"the software shall be used for good not evil"), ("proprietary", "proprietary", TEXT, r"proprietary and confidential"),
    ("proprietary", "reserved", TEXT, r"all rights reserved"),
    ("copyright", "copyright", NAME, r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*"),
]

#: label stem, keyword of the written-out name, name, short name (empty: none), versions
_FAMILIES = [
    ("gpl", "general", r"(?:gnu )?general public licen[cs]e", "gpl", ("1.0", "2.0", "3.0")),
    ("lgpl", "general", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", "lgpl", ("2.0", "2.1", "3.0")),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e", "agpl", ("1.0", "3.0")),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[cs]e", "gfdl", ("1.1", "1.2", "1.3")),
    ("apache", "apache", r"apache(?: software)?(?: licen[cs]e)?", "", ("1.0", "1.1", "2.0")),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", "mpl", ("1.0", "1.1", "2.0")),
    ("epl", "eclipse", r"eclipse public licen[cs]e", "epl", ("1.0", "2.0")),
    ("cddl", "development", r"common development and distribution licen[cs]e", "cddl", ("1.0", "1.1")),
    ("eupl", "union", r"european union public licen[cs]e", "eupl", ("1.0", "1.1", "1.2")),
    ("osl", "open", r"open software licen[cs]e", "osl", ("1.0", "2.0", "2.1", "3.0")),
    ("afl", "academic", r"academic free licen[cs]e", "afl", ("1.1", "2.0", "2.1", "3.0")),
    ("artistic", "artistic", r"artistic licen[cs]e", "", ("1.0", "2.0")),
    ("lppl", "latex", r"latex project public licen[cs]e", "lppl", ("1.0", "1.1", "1.2", "1.3")),
    ("ofl", "font", r"(?:sil )?open font licen[cs]e", "ofl", ("1.0", "1.1")),
    ("cecill", "cecill", r"cecill(?: free software)?(?: licen[cs]e)?", "", ("1.0", "2.0", "2.1")),
    ("zpl", "zope", r"zope public licen[cs]e", "zpl", ("1.1", "2.0", "2.1")),
    ("php", "php", r"php licen[cs]e", "", ("3.0", "3.01")),
    ("odbl", "database", r"open (?:data commons open )?database licen[cs]e", "odbl", ("1.0",)),
    ("ecl", "community", r"educational community licen[cs]e", "ecl", ("1.0", "2.0")),
]
_COMMONS = [("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nc", "attribution non ?commercial"),
            ("by-nd", "attribution no ?deriv(?:ative)?s(?: works)?"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
            ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s(?: works)?")]
_TAGS = ["mit", "isc", "0bsd", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause", "unlicense", "zlib", "wtfpl", "cc0-1.0", "bsl-1.0",
         "ncsa", "postgresql", "x11", "ms-pl", "upl-1.0", "psf-2.0", "openssl"]


def _spaced(version: str) -> str:
    """``2.1`` as words; a trailing zero may be missing."""
    major, minor = version.split(".")
    return f"{major}(?: {minor})?" if minor == "0" else f"{major} {minor}"


def rules() -> list[Rule]:
    """All rules in order; versions, tags and short names follow from the families."""
    out = [Rule(label, word, prio, _WEIGHT[prio], p) for label, word, prio, p in _BY_HAND]
    later = r"(?: of the licen[cs]e)?(?: or)?(?: at your option)? any later version"
    tagged = list(_TAGS)
    for stem, word, name, short, versions in _FAMILIES:
        for v in versions:
            label, number = f"{stem}-{v}", f"(?: version| v)? (?:v)?{_spaced(v)}"
            published = r"(?: as published by the free software foundation(?: either)?)?" if stem.endswith("gpl") else ""
            out.append(Rule(label, word, VERSIONED, _WEIGHT[VERSIONED], f"{name}{published}{number}"))
            tagged += [label]
            if short:
                out += [Rule(label, s, VERSIONED, _WEIGHT[VERSIONED], f"{s}{tail}") for s, tail in
                        ((short, number), (f"{short}v{v.split('.')[0]}", "" if v.endswith(".0") else f" {v.split('.')[1]}"))]
            if published:
                out.append(Rule(f"{label}-or-later", word, VERSIONED, 0.9, f"{name}{published}{number}{later}"))
                tagged += [f"{label}-only", f"{label}-or-later"]
    for code, name in _COMMONS:
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            label = f"cc-{code}-{v}"
            out.append(Rule(label, "cc", VERSIONED, _WEIGHT[VERSIONED], f"cc {code.replace('-', ' ')} {_spaced(v)}"))
            out.append(Rule(label, "creative", VERSIONED, _WEIGHT[VERSIONED],
                            f"creative commons {name}(?: {v.replace('.', ' ')}|(?: international| unported| generic)?(?: public)? licen[cs]e"
                            f"(?: version| v)? {v.replace('.', ' ')})"))
            tagged.append(label)
    out += [Rule(t, "spdx", TAG, _WEIGHT[TAG], f"spdx licen[cs]e identifier {t.replace('-', ' ').replace('.', ' ')}") for t in tagged]
    return out


def _bounded(pattern: str) -> str:
    return f"(?<![^ ])(?:{pattern})(?![^ ])"


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(words: Column, pattern: Column) -> Column:
    """(start, words) of each match of ``pattern`` in words joined by one space, words counted from 0."""
    found = F.regexp_extract_all(words, pattern, F.lit(0))
    between = F.split(words, pattern, -1)
    spans = "array<struct<start:bigint,size:bigint>>"
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(spans).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin, inner = acc["at"] + _spaces(x["piece"]), _spaces(x["hit"])
        span = F.struct(begin.cast("bigint").alias("start"), (inner + 1).cast("bigint").alias("size"))
        return F.struct((begin + inner).cast("bigint").alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    pairs = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda p, h: F.struct(p.alias("piece"), h.alias("hit")))
    return F.when(F.size(found) > 0, F.aggregate(pairs, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(spans))


def _surviving(found: Column) -> Column:
    """Detections that lie in no other of the same or a better priority."""
    shape = "array<struct<start:bigint,back:bigint,priority:int,rank:int,label:string,weight:double>>"
    none = F.lit(-1).cast("bigint")
    start = F.struct(*[none.alias(f"m{p}") for p in range(4)], F.array().cast(shape).alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        end = -x["back"]
        inside = F.lit(False)
        for p in range(4):
            inside = inside | ((x["priority"] >= p) & (acc[f"m{p}"] >= end))
        reach = [F.when(x["priority"] == p, F.greatest(acc[f"m{p}"], end)).otherwise(acc[f"m{p}"]).alias(f"m{p}") for p in range(4)]
        return F.struct(*reach, F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(x))).alias("kept"))

    return F.aggregate(F.array_sort(found), start, step, lambda acc: acc["kept"])


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``base`` (start, size, label) and ``detections`` (start, end, priority, label, weight)
    per row of ``df``."""
    known = rules()
    table_ = F.array(*[F.struct(F.lit(r.keyword).alias("keyword"), F.lit(r.priority).alias("priority"), F.lit(i).alias("rank"),
                                F.lit(r.label).alias("label"), F.lit(r.weight).alias("weight"),
                                F.lit(_bounded(r.pattern)).alias("pattern")) for i, r in enumerate(known)])
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in known})])
    docs = df.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    # lower() also changes letters beyond A-Z, but none of them into another word or a base phrase
    words = docs.select("__id", F.regexp_extract_all(F.lower("__text"), F.lit(f"({WORD})"), F.lit(1)).alias("__words"))
    met = words.select("__id", "__words", F.array_intersect("__words", keywords).alias("__keywords"))
    some = F.size("__keywords") > 0
    joined = met.select("__id", F.size("__words").cast("bigint").alias("n_words"), "__keywords",
                        F.when(some, F.array_join("__words", " ")).otherwise("").alias("__joined"))
    base = F.array().cast("array<struct<start:bigint,size:bigint,label:string>>")
    for phrase, label in BASE.items():
        base = F.concat(base, _labelled(_places(F.col("__joined"), F.lit(_bounded(phrase))), label))
    hits = F.flatten(F.transform(
        F.filter(table_, lambda r: F.array_contains(F.col("__keywords"), r["keyword"])),
        lambda r: F.transform(_places(F.col("__joined"), r["pattern"]), lambda s: F.struct(
            s["start"].alias("start"), (-(s["start"] + s["size"])).alias("back"), r["priority"].alias("priority"),
            r["rank"].alias("rank"), r["label"].alias("label"), r["weight"].alias("weight")))))
    found = joined.select("__id", "n_words", F.when(some, base).alias("base"),
                          F.when(some, hits).alias("__hits"))
    kept = F.transform(_surviving(F.col("__hits")), lambda x: F.struct(
        x["start"].alias("start"), (-x["back"]).alias("end"), x["priority"].alias("priority"), x["label"].alias("label"),
        x["weight"].alias("weight")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,priority:int,label:string,weight:double>>")
    return found.select(F.col("__id").alias(id_col), "n_words",
                        F.coalesce("base", F.array().cast("array<struct<start:bigint,size:bigint,label:string>>")).alias("base"),
                        F.coalesce(kept, none).alias("detections"))


def _labelled(spans: Column, label: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["size"].alias("size"), F.lit(label).alias("label")))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct(F.col("base.label")))
    labels = F.array_sort(F.array_distinct(F.concat(F.col("base.label"), F.col("detections.label"))))
    weights = F.concat(F.col("detections.weight"), F.transform("base", lambda b: F.lit(BASE_WEIGHT)))
    return found.select("doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
                        F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
                        F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"))
