"""Connected components over an edge table, in rounds of joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.scratch import BROADCAST_ROWS, discard, stored, with_keys
from lectern.operators.relational import join_per_key

PIVOT_ROUNDS = 2
#: Pivots of a list in the rounds that follow, each over its own share of the lists.
MANY_PIVOTS = (8, 32)
#: Pairs for each entry of a list up to which no such round is worth its while.
PAIRS_AN_ENTRY = 64


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """Label each node of ``edges(a, b)`` with the smallest node it can reach.

    Every round sends a node the smallest label among its neighbours, then
    follows that label's own label (pointer jumping), so long chains shrink by
    half each time.  Only rows (node, label) move; a node with very many
    neighbours costs one partial minimum per task, and the joins against the
    labels are splittable.  Nulls and loops in ``edges`` add nothing.

    Returns node, label for the nodes that have an edge.
    """
    pairs = edges.where("a is not null and b is not null and a <> b").select(
        F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")
    )
    arcs = stored(pairs.union(pairs.select("b", "a")).distinct(), "arcs")
    labels = arcs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")
    )
    labels = stored(labels, "labels")
    for _ in range(rounds):
        known = labels.select(F.col("node").alias("b"), F.col("label").alias("seen"))
        near = arcs.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("near"))
        # A label that a node gives up must learn of the better one as well.
        told = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("best"))
        told = stored(told, "told")
        hooked = told.groupBy(F.col("label").alias("node")).agg(F.min("best").alias("hook"))
        merged = told.join(hooked, "node", "left").select(
            "node", "label", F.least("best", F.coalesce("hook", "best")).alias("best")
        )
        merged = stored(merged, "merged")
        jump = merged.select(F.col("node").alias("best"), F.col("best").alias("further"))
        after = stored(
            merged.join(jump, "best").select("node", "label", F.col("further").alias("now")), "labels"
        )
        discard(told, merged)
        moved = after.where("now <> label").limit(1).count()
        labels = after.select("node", F.col("now").alias("label"))
        if not moved:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def list_links(
    entries: DataFrame,
    payload: Sequence[str],
    fits: Callable[[str, str], Column],
    confirm: Callable[[DataFrame], DataFrame],
    rounds: int = PIVOT_ROUNDS,
    last: tuple[Callable[[DataFrame], DataFrame], Sequence[str], Callable[[str, str], Column]] | None = None,
    spent: Sequence[DataFrame] = (),
) -> DataFrame:
    """Links between nodes that meet in a list, enough to join every component.

    ``entries`` has key (of the list), node, weight and the ``payload`` columns.
    ``confirm`` gets candidate pairs a, b with the payload of both as a_*, b_*,
    possibly more than once, and returns the linked pairs (a, b).  ``fits(x, y)``
    is a cheap condition on two column prefixes.

    In each round every list is compared with its heaviest node, which then
    leaves it; a list whose nodes are all in one component needs no more work.
    What is left after the rounds is compared pair by pair, but only across
    components.  A list of many near copies so costs a few times its length.

    Nodes of which only some are linked are joined by few of these rounds.  While the
    lists hold many more pairs than entries, rounds with several pivots for each list
    come before the pairs (`pivot_links`); they leave no pair out.

    ``last`` sharpens what follows the first rounds: a function that adds columns to what is left,
    their names, and the condition that stands there for ``fits``.  ``spent`` are stored
    tables that only ``entries`` are made from, deleted once the lists are written.
    """
    columns = ["key", "node", "weight", *payload]

    def side(df: DataFrame, prefix: str) -> list[Column]:
        return [F.col("node").alias(prefix), *[F.col(c).alias(f"{prefix}_{c}") for c in payload]]

    many = stored(entries.groupBy("key").agg(F.count(F.lit(1)).alias("met")).where("met > 1").select("key"), "keys")
    rest = stored(with_keys(entries.select(*columns), many, "key").withColumn("label", F.col("node")), "lists")
    discard(*spent, many)
    found = None
    for _ in range(rounds):
        central = rest.groupBy("key").agg(F.max(F.struct("weight", "node", "label", *payload)).alias("c")).select(
            "key", F.col("c.node").alias("b"), F.col("c.label").alias("b_label"),
            *[F.col(f"c.{c}").alias(f"b_{c}") for c in payload])
        met = stored(join_per_key(rest, central, "key"), "met")
        near = met.where("label <> b_label").select(
            *side(met, "a"), "b", *[f"b_{c}" for c in payload]).where(fits("a", "b"))
        links = confirm(near)
        found = stored(links if found is None else found.union(links), "links")
        better = components(found).select(F.col("node").alias("known"), F.col("label").alias("better"))
        left = met.where("node <> b").join(better, F.col("node") == F.col("known"), "left").select(
            *columns, F.coalesce("better", "node").alias("label"))
        left = stored(left, "left")
        discard(met, rest)
        mixed = left.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
        rest = stored(join_per_key(left, mixed, "key"), "lists")
        discard(left)
        if rest.isEmpty():
            return found
    if last is not None:
        add, more, fits = last
        plain, rest, payload = rest, add(rest), [*payload, *more]
        discard(plain)
    found, rest = pivot_links(rest, found, payload, fits, confirm)
    near = across(rest, rest, payload).where("a < b and a_label <> b_label").where(fits("a", "b"))
    links = stored(found.union(confirm(near.select("a", "b", *[f"{p}_{c}" for p in "ab" for c in payload]))), "links")
    discard(rest)
    return links


def across(one: DataFrame, two: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Pairs a, b of entries of one list with their labels and payload, as the columns a_*, b_*."""

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select("key", F.col("key").alias(f"{prefix}_key"), F.col("node").alias(prefix), *[F.col(c).alias(f"{prefix}_{c}") for c in ["label", *payload]])

    return side(one, "a").join(side(two, "b"), "key")


def relabelled(rest: DataFrame, found: DataFrame) -> DataFrame:
    """The entries with the labels of the components of all links found."""
    better = stored(components(found).select(F.col("node").alias("known"), F.col("label").alias("better")), "better")
    if better.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        better = F.broadcast(better)
    return rest.join(better, F.col("node") == F.col("known"), "left").withColumn(
        "label", F.coalesce("better", "label")).drop("known", "better")


def pivot_links(
    rest: DataFrame, found: DataFrame, payload: Sequence[str],
    fits: Callable[[str, str], Column], confirm: Callable[[DataFrame], DataFrame],
) -> tuple[DataFrame, DataFrame]:
    """The links with those of several pivots for each list, and what is then left of the lists.

    Round by round each list of one share of all lists is compared with its pivots, which then
    leave it.  They are the nodes of the smallest hash, so lists of the same
    nodes have the same pivots; a node that one of them is linked to
    needs no comparison with the others of its component.
    """
    share = len(MANY_PIVOTS)
    for at, pivots in enumerate(MANY_PIVOTS):
        met = rest.groupBy("key").agg(F.count(F.lit(1)).alias("met"))
        entries, pairs = met.agg(F.sum("met"), F.sum(F.expr("met * (met - 1) / 2"))).first()
        if not entries or pairs <= PAIRS_AN_ENTRY * entries:
            break
        turn = F.pmod(F.xxhash64("key", F.lit(share)), F.lit(share)) == at
        draw = F.pmod(F.xxhash64("node", F.lit(share)), F.lit(1 << 30))
        sized = stored(
            join_per_key(rest.where(turn), met.where(turn), "key")
            .withColumn("pivot", draw * F.col("met") < F.lit(pivots << 30)).drop("met"), "sized")
        near = across(sized, sized.where("pivot"), ["pivot", *payload]).where(
            "a_label <> b_label and (a < b or not a_pivot)").where(fits("a", "b"))
        links = confirm(near.select("a", "b", *[f"{p}_{c}" for p in "ab" for c in payload]))
        found = stored(found.union(links), "links")
        left = rest.where(~turn).union(sized.where("not pivot").select(*rest.columns))
        left = stored(relabelled(left, found), "left")
        discard(sized, rest)
        mixed = left.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
        rest = stored(join_per_key(left, mixed, "key"), "lists")
        discard(left)
    return found, rest
