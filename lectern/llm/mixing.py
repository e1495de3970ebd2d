"""Mixing sources to target weights: capped water-filling and seeded repetition.

A source's share of the mix follows its weight until its target reaches the most
epochs of its size; what is over goes to the others by weight, until none is
above its cap.  Only the level (words per unit of weight) passes between the
rounds, so a round is one small aggregate over the sources.

A target of e epochs takes every document of the source floor(e) times and, for
the rest, documents in the order of a seeded hash until it is filled; the last
one is taken in part.  The running sums come from two histograms of the hash,
4096 cells each; only the documents of the one cell where a source's rest ends
are ordered, so no source passes through one task.

A null text has size 0; a source of size 0 has target 0.  Null is a source of
its own and comes last.  Repeated rows are documents of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.scratch import need, stored
from lectern.operators.relational import join_per_key

WEIGHTS = (5, 2, 1)
SHARE, MOST_EPOCHS, SEED = 1.5, 2, "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str = SEED) -> DataFrame:
    """row_id, source, size, and the seeded order of every row."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    return docs.select(F.col(id_col).cast("long").alias("row_id"), F.col(source_col).cast("string").alias("source"),
                       size.alias("size"), order.alias("order"))


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Add target to sources(source, source_size), one row per source."""
    # One row per source: their order is a matter of names, not of documents.
    place = F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = stored(sources.withColumn("weight", weight.cast("double")).withColumn(
        "cap", (F.col("source_size") * most_epochs).cast("double")), "sources")
    goal = share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("cap") < F.lit(level) * F.col("weight")
        row = weighed.agg(F.sum(F.when(full, F.col("cap"))).alias("clamped"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not row["open"]:
            level = float("inf")
            break
        raised = (goal - (row["clamped"] or 0.0)) / row["open"]
        if raised <= level:
            break
        level = raised
    share_of = F.lit(level) * F.col("weight")
    return weighed.withColumn("target", F.when(F.col("cap") < share_of, F.col("cap")).otherwise(share_of))


def _cell(rest: DataFrame, rows: DataFrame, name: str, before: Column) -> DataFrame:
    """The cell of histogram ``name`` in which each source's rest ends, and the words before it."""
    sums = rows.groupBy("source_key", name).agg(F.sum("size").alias("words"))
    upto = W.partitionBy("source_key").orderBy(name)
    running = sums.withColumn("upto", F.sum("words").over(upto))
    return running.join(rest, "source_key").withColumn("start", before + F.col("upto") - F.col("words")).where(
        (F.col("start") < F.col("rest")) & (F.col("start") + F.col("words") >= F.col("rest")))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: Sequence[int] = WEIGHTS, share: float = SHARE, most_epochs: int = MOST_EPOCHS,
          seed: str = SEED) -> DataFrame:
    """row_id, size, source_size, target, taken (words in the mix, repeats counted) for every row."""
    need(docs, [id_col, text_col, source_col])
    # A null source has a key of its own; the prefix keeps it apart from any name.
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    rows = stored(
        sized(docs, id_col, text_col, source_col, seed).withColumn("source_key", key)
        .withColumn("outer", F.substring("order", 1, 3)).withColumn("inner", F.substring("order", 4, 3)), "sized")
    sources = source_targets(rows.groupBy("source", "source_key").agg(F.sum("size").alias("source_size")), weights, share, most_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = stored(
        sources.withColumn("whole", whole)
        .withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
        .select("source_key", "source_size", "target", "whole", "rest"), "plan")
    rest = plan.where("rest > 0").select("source_key", "rest")
    outer = stored(_cell(rest, rows, "outer", F.lit(0)).select(
        "source_key", "rest", F.col("outer").alias("outer_end"), F.col("start").alias("outer_start")), "outer")
    # The rows of one outer cell a source, written: what is ordered below starts from these few, not from a
    # join of all rows, which adaptive execution could not split under a window.
    ends = outer.select("source_key", "outer_end")
    edge = stored(join_per_key(rows, ends, "source_key").where("outer = outer_end").drop("outer_end"), "edge")
    inner = stored(_cell(outer, edge, "inner", F.col("outer_start")).select(
        "source_key", "outer_end", F.col("inner").alias("inner_end"), F.col("start").alias("inner_start")), "inner")
    cuts = plan.join(inner, "source_key", "left")
    side = F.expr("case when outer_end is null or outer > outer_end then 1 when outer < outer_end then -1 "
                  "when inner > inner_end then 1 when inner < inner_end then -1 else 0 end")
    upto = W.partitionBy("source_key").orderBy("order", "row_id", "size").rowsBetween(W.unboundedPreceding, -1)
    # Adding the source's size for the fraction: documents before the end count in full.
    clear = join_per_key(rows, cuts, "source_key").withColumn("side", side).where("side <> 0").withColumn(
        "part", F.when(F.col("side") < 0, F.col("size")).otherwise(F.lit(0))).drop("side")
    ending = join_per_key(edge, cuts, "source_key").where("inner = inner_end").withColumn(
        "earlier", F.col("inner_start") + F.coalesce(F.sum("size").over(upto), F.lit(0))).withColumn(
        "part", F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("earlier")))).drop("earlier")
    return clear.unionByName(ending).select(
        "row_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def mixing_sql(table: str = "documents", seed: str = SEED) -> str:
    """The same in DuckDB SQL, with the default weights, over a table of documents."""
    return f"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) as bigint) as size,
         md5('{seed}:' || coalesce(cast(doc_id as varchar), '')) as h
  from {table}
), s as (
  select source, cast(sum(size) as bigint) as source_size,
         cast([5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as double) as weight
  from d group by source
), c as (
  select *, cast({MOST_EPOCHS} * source_size as double) as cap, {SHARE} * sum(source_size) over () as goal from s
), f as (
  select *, coalesce(sum(cap) over w, 0) as clamped,
         sum(weight) over () - coalesce(sum(weight) over w, 0) as open, row_number() over (order by cap / weight, source) as place
  from c window w as (order by cap / weight, source rows between unbounded preceding and 1 preceding)
), l as (
  select arg_min((goal - clamped) / open, place) filter (cap >= (goal - clamped) / open * weight) as level from f
), t as (
  select source, source_size, case when level is null or cap < level * weight then cap else level * weight end as target
  from c, l
), p as (
  select *, cast(case when source_size > 0 then floor(target / source_size) else 0 end as bigint) as whole
  from t
), r as (
  select *, cast(round(target - whole * source_size) as bigint) as rest from p
)
select doc_id, size, source_size, target, cast(whole * size + greatest(0, least(size, rest - coalesce(
         sum(size) over (partition by d.source order by h, doc_id, size rows between unbounded preceding and 1 preceding), 0))) as bigint) as taken
from d join r on d.source is not distinct from r.source"""
