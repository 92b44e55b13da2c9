"""Mixing sources to target weights, in DataFrame functions only.

The corpus is a tree: domain, language, source.  A token budget enters at the root.  At each node it is
shared among the children by weight; a child that cannot use its share (its tokens times the
epochs allowed) is filled, and what it leaves goes to its siblings by weight.  No node ever gets
more than its children hold, so a shortage leaves a node only when all its children are full, and
then goes to the node's own siblings.  All shares are whole tokens and add up exactly.

A leaf takes whole epochs of its documents, then a prefix of one more epoch: documents in the order of
a seeded hash of epoch and id until the leaf's tokens are used up, the last document cut short.  To find
that prefix no leaf is sorted as a whole: hash digits split it into 4,096 buckets whose sums are
added up, and the bucket with the cut is split again.  In that last bucket rows of one id and length are added up into
one class first, which may be a third of all rows (a missing id); only the classes are ordered, and the class with the cut is
written out again from its numbers, in pieces of ``PIECE_ROWS`` rows dealt over the tasks.

Tokens are words parted by white space (space, tab, line feed, vertical tab, form feed, return).  Null and
empty texts have none and are never taken.  A null language is ``und``, a null source ``unknown``, a null
id ``null`` in the hash.  Rows of one leaf that agree in id and tokens are interchangeable; other columns are
not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimwright.llm.common import save_table, table

WHOLE = "decimal(38,0)"
TOKEN = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")

#: the production mix: sources of each domain, weights (whole numbers) and defaults for anything else
DOMAINS = {"web": [f"src{i}" for i in range(8)], "reference": [f"src{i}" for i in range(8, 14)],
           "forum": [f"src{i}" for i in range(14, 20)]}
OTHER_DOMAIN = "other"
WEIGHTS = {"domain": {"web": 40, "reference": 40, "forum": 20}, "lang": {"en": 50, "de": 20, "fr": 20, "es": 10},
           "source": {"src0": 3, "src8": 2}}
DEFAULT_WEIGHT = {"domain": 5, "lang": 5, "source": 1}
#: rows that one task writes out of a class
PIECE_ROWS = 4096
#: budget as a share of all tokens, epochs allowed, seed
SHARE, EPOCHS, SEED = (3, 5), 2, "mix-1"


def lookup(col: Column, values: Mapping, default) -> Column:
    if not values:
        return F.lit(default)
    pairs = F.create_map(*[F.lit(x) for k, v in values.items() for x in (k, v)])
    return F.coalesce(F.element_at(pairs, col), F.lit(default))


def share_out(children: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """Add ``quota`` to rows of (parents, name, weight, cap, budget): the parent's budget shared by weight, at most
    ``cap`` each, the shares of full children passed on to the others."""
    group = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ratio = F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight")).otherwise(-1.0)
    by_ratio = group.orderBy("__ratio", name)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    df = children.withColumns({"weight": F.col("weight").cast(WHOLE), "cap": F.col("cap").cast(WHOLE),
                               "budget": F.col("budget").cast(WHOLE)})
    df = df.withColumn("__ratio", ratio).withColumns({
        "__cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(WHOLE),
        "__weight_left": (F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast(WHOLE)})
    df = df.withColumn("__fits", (F.col("cap") * F.col("__weight_left")
                                  <= F.col("weight") * (F.col("budget") - F.col("__cap_before"))).cast("int"))
    df = df.withColumn("__full", F.min("__fits").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    df = df.withColumns({
        "__rest": (F.col("budget") - F.coalesce(F.sum(F.when(F.col("__full"), F.col("cap"))).over(group), F.lit(0))).cast(WHOLE),
        "__weights": F.coalesce(F.sum(F.when(~F.col("__full"), F.col("weight"))).over(group), F.lit(0)).cast(WHOLE)})
    df = df.withColumn("__part", F.when(~F.col("__full"), F.expr("(weight * __rest) div __weights").cast(WHOLE)))
    by_name = group.orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({"__odd": (F.col("__rest") - F.coalesce(F.sum("__part").over(group), F.lit(0))).cast(WHOLE),
                         "__rank": F.sum(F.when(~F.col("__full"), 1).otherwise(0)).over(by_name)})
    quota = F.when(F.col("__full"), F.col("cap")).otherwise(F.col("__part") + F.when(F.col("__rank") <= F.col("__odd"), 1).otherwise(0))
    return df.withColumn("quota", quota.cast(WHOLE)).drop(*[c for c in df.columns if c.startswith("__")])


def leaf_quotas(leaves: DataFrame, budget: int, epochs: int, weights: Mapping = WEIGHTS, defaults: Mapping = DEFAULT_WEIGHT) -> DataFrame:
    """Add ``quota`` to rows of (domain, lang, source, tokens): the budget propagated down the tree."""
    w = {lv: lookup(F.col(lv), weights.get(lv, {}), defaults[lv]) for lv in LEVELS}
    useful = (w["domain"] > 0) & (w["lang"] > 0) & (w["source"] > 0)
    leaves = leaves.withColumn("cap", F.when(useful, F.col("tokens") * epochs).otherwise(0).cast(WHOLE))
    budget = min(budget, int(leaves.agg(F.coalesce(F.sum("cap"), F.lit(0)).alias("c")).first()["c"]))
    level = leaves.groupBy("domain").agg(F.sum("cap").alias("cap"))
    level = level.withColumns({"budget": F.lit(budget).cast(WHOLE), "weight": w["domain"]})
    level = share_out(level, [], "domain").select("domain", F.col("quota").alias("budget"))
    level = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(level, "domain").withColumn("weight", w["lang"])
    level = share_out(level, ["domain"], "lang").select("domain", "lang", F.col("quota").alias("budget"))
    level = leaves.join(level, ["domain", "lang"]).withColumn("weight", w["source"])
    return share_out(level, ["domain", "lang"], "source").select(*LEVELS, "tokens", "quota")


def cut_by(rows: DataFrame, digits: str) -> DataFrame:
    """Sums per leaf and bucket of ``digits``, with the tokens of the buckets before."""
    sums = rows.groupBy("leaf", digits).agg(F.sum("n_tokens").alias("inside"))
    before = Window.partitionBy("leaf").orderBy(digits).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("before", F.coalesce(F.sum("inside").over(before), F.lit(0)))


def cut_classes(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """``names`` and ``extra`` of the rows of the last buckets: taken in the order of key, id and tokens up to ``rest``."""
    classes = rows.groupBy("leaf", "key", *names, "rest", "before").agg(F.count(F.lit(1)).alias("many"))
    order = Window.partitionBy("leaf").orderBy("key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    done = F.col("before") + F.coalesce(F.sum(F.col("many") * F.col("n_tokens")).over(order), F.lit(0))
    classes = classes.withColumn("room", F.greatest(F.lit(0), F.col("rest") - done).cast("long"))
    whole = F.when(F.col("n_tokens") > 0, F.least("many", F.expr("room div n_tokens"))).otherwise(0).cast("long")
    classes = classes.withColumn("whole", whole).withColumn("part", F.when(F.col("whole") < F.col("many"), F.least(
        "n_tokens", F.col("room") - F.col("whole") * F.col("n_tokens"))).otherwise(0).cast("long"))
    some = (F.col("part") > 0).cast("long")
    takes = F.array(F.struct(F.col("n_tokens").alias("extra"), F.col("whole").alias("n")), F.struct(F.col("part").alias("extra"), some.alias("n")),
                    F.struct(F.lit(0).cast("long").alias("extra"), (F.col("many") - F.col("whole") - some).alias("n")))
    taken = classes.select(*names, F.explode(takes).alias("t")).filter("t.n > 0").select(*names, "t.extra", "t.n")
    pieces = taken.select(*names, "extra", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {PIECE_ROWS}"))).alias("piece"))
    pieces = pieces.repartition(*names, "extra", "piece")
    inside = F.least(F.lit(PIECE_ROWS).cast("long"), F.col("n") - F.col("piece") * PIECE_ROWS)
    return pieces.select(*names, "extra", F.explode(F.sequence(F.lit(1).cast("long"), inside)).alias("nth")).drop("nth")


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                domains: Mapping = DOMAINS, weights: Mapping = WEIGHTS, defaults: Mapping = DEFAULT_WEIGHT,
                share: tuple[int, int] = SHARE, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per row of ``df``: id (as ``doc_id``), ``domain``, ``lang``, ``source``, ``n_tokens``, ``copies`` (epochs it is
    taken in, the last perhaps in part), ``taken_tokens`` and ``kept`` (any taken)."""
    text = F.col(f"`{text_col}`")
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"),
                     F.coalesce(F.col(f"`{source_col}`"), F.lit("unknown")).alias("source"),
                     F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long").alias("n_tokens"))
    docs = docs.withColumn("domain", lookup(F.col("source"), {s: d for d, ss in domains.items() for s in ss}, OTHER_DOMAIN))
    docs = save_table(docs, "mix-documents")
    leaves = save_table(docs.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    total = leaves.agg(F.coalesce(F.sum(F.col("tokens").cast(WHOLE)), F.lit(0)).alias("t")).first()["t"]
    quotas = leaf_quotas(leaves, int(total) * share[0] // share[1], epochs, weights, defaults)
    whole = F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(0).cast("long")
    quotas = quotas.withColumn("epochs", whole).withColumn("rest", (F.col("quota") - F.col("epochs") * F.col("tokens")).cast("long"))
    quotas = save_table(quotas.select(*LEVELS, "epochs", "rest").withColumn("leaf", F.monotonically_increasing_id()), "mix-quotas")

    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("epochs"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    rows = docs.join(quotas, list(LEVELS)).withColumn("key", key)
    rows = save_table(rows.select("*", F.substring("key", 1, 3).alias("d1"), F.substring("key", 4, 3).alias("d2")), "mix-rows")
    partial = rows.filter("rest > 0")
    first = cut_by(partial, "d1")
    placed = rows.join(first, ["leaf", "d1"], "left")
    # the bucket that holds the cut, if it is not at its edge
    cut = (F.col("before") < F.col("rest")) & (F.col("rest") < F.col("before") + F.col("inside"))
    whole_bucket = F.col("before") + F.col("inside") <= F.col("rest")
    names = ["doc_id", *LEVELS, "n_tokens", "epochs"]
    sure = placed.filter(~F.coalesce(cut, F.lit(False))).select(*names, F.when(whole_bucket, F.col("n_tokens")).otherwise(0).alias("extra"))
    near = save_table(placed.filter(cut).select(*names, "leaf", "key", "d2", (F.col("rest") - F.col("before")).alias("rest")), "mix-cut")
    placed = near.join(cut_by(near, "d2"), ["leaf", "d2"])
    sure2 = placed.filter(~cut).select(*names, F.when(whole_bucket, F.col("n_tokens")).otherwise(0).alias("extra"))
    last = cut_classes(placed.filter(cut), names)
    out = sure.unionByName(sure2).unionByName(last)
    taken = (F.col("epochs") * F.col("n_tokens") + F.col("extra")).cast("long")
    copies = F.when(F.col("n_tokens") > 0, F.col("epochs") + (F.col("extra") > 0).cast("long")).otherwise(0).cast("long")
    return out.select("doc_id", *LEVELS, "n_tokens", copies.alias("copies"), taken.alias("taken_tokens"), (taken > 0).alias("kept"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def _case(col: str, values: Mapping, default) -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {quote(v)}" for k, v in values.items()) + f" ELSE {quote(default)} END"


def _share_sql(source: str, parents: str, name: str, out: str) -> str:
    part = f"PARTITION BY {parents}" if parents else ""
    return f"""
{out}_1 AS (SELECT *, CASE WHEN weight > 0 THEN CAST(cap AS DOUBLE) / weight ELSE -1.0 END AS ratio FROM {source}),
{out}_2 AS (SELECT *, coalesce(sum(cap) OVER b, 0) AS cap_before,
    sum(weight) OVER ({part}) - coalesce(sum(weight) OVER b, 0) AS weight_left FROM {out}_1
    WINDOW b AS ({part} ORDER BY ratio, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{out}_3 AS (SELECT *, min(CASE WHEN cap * weight_left <= weight * (budget - cap_before) THEN 1 ELSE 0 END)
    OVER ({part} ORDER BY ratio, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AS filled FROM {out}_2),
{out}_4 AS (SELECT *, budget - coalesce(sum(cap) FILTER (filled) OVER ({part}), 0) AS rest,
    sum(weight) FILTER (NOT filled) OVER ({part}) AS weights FROM {out}_3),
{out}_5 AS (SELECT *, CASE WHEN NOT filled THEN (weight * rest) // weights END AS piece FROM {out}_4),
{out}_6 AS (SELECT *, rest - coalesce(sum(piece) OVER ({part}), 0) AS odd,
    sum(CASE WHEN filled THEN 0 ELSE 1 END) OVER ({part} ORDER BY {name} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nth
    FROM {out}_5),
{out} AS (SELECT *, CASE WHEN filled THEN cap ELSE piece + CASE WHEN nth <= odd THEN 1 ELSE 0 END END AS quota FROM {out}_6)"""


_SOURCES = {s: d for d, ss in DOMAINS.items() for s in ss}
_W = {lv: _case(lv, WEIGHTS.get(lv, {}), DEFAULT_WEIGHT[lv]) for lv in LEVELS}
ORACLE = rf"""
WITH docs AS (SELECT doc_id, text, coalesce(lang, 'und') AS lang, coalesce(source, 'unknown') AS source,
    {_case("coalesce(source, 'unknown')", _SOURCES, OTHER_DOMAIN)} AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens,
    CASE WHEN {_W['domain']} > 0 AND {_W['lang']} > 0 AND {_W['source']} > 0 THEN sum(n_tokens) * {EPOCHS} ELSE 0 END::HUGEINT AS cap
    FROM docs GROUP BY domain, lang, source),
root AS (SELECT least((sum(tokens) * {SHARE[0]}) // {SHARE[1]}, sum(cap))::HUGEINT AS budget FROM leaves),
c1 AS (SELECT domain, sum(cap)::HUGEINT AS cap, any_value(budget) AS budget, ({_W['domain']})::HUGEINT AS weight FROM leaves, root GROUP BY domain),
{_share_sql("c1", "", "domain", "q1")},
c2 AS (SELECT l.domain, l.lang, sum(l.cap)::HUGEINT AS cap, any_value(q1.quota) AS budget, ({_case("l.lang", WEIGHTS["lang"], DEFAULT_WEIGHT["lang"])})::HUGEINT AS weight
    FROM leaves l JOIN q1 ON q1.domain = l.domain GROUP BY l.domain, l.lang),
{_share_sql("c2", "domain", "lang", "q2")},
c3 AS (SELECT l.domain, l.lang, l.source, l.tokens, l.cap, q2.quota AS budget, ({_case("l.source", WEIGHTS["source"], DEFAULT_WEIGHT["source"])})::HUGEINT AS weight
    FROM leaves l JOIN q2 ON q2.domain = l.domain AND q2.lang = l.lang),
{_share_sql("c3", "domain, lang", "source", "q3")},
plan AS (SELECT domain, lang, source, tokens, quota, CASE WHEN tokens > 0 THEN quota // tokens ELSE 0 END AS epochs FROM q3),
keyed AS (SELECT d.*, p.epochs, p.quota - p.epochs * p.tokens AS rest,
    md5('{SEED}:' || p.epochs || ':' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')) AS k
    FROM docs d JOIN plan p ON p.domain = d.domain AND p.lang = d.lang AND p.source = d.source),
placed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k, doc_id, n_tokens, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM keyed),
taken AS (SELECT *, greatest(0, least(n_tokens, rest - done)) AS extra FROM placed)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens,
    CAST(CASE WHEN n_tokens > 0 THEN epochs + CASE WHEN extra > 0 THEN 1 ELSE 0 END ELSE 0 END AS BIGINT) AS copies,
    CAST(epochs * n_tokens + extra AS BIGINT) AS taken_tokens, epochs * n_tokens + extra > 0 AS kept FROM taken
"""
