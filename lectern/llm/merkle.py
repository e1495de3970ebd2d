"""Merkle manifest of a dataset: checkpoints of the tree, proofs by recomputing.

Every row is a leaf, the digest of its columns.  The leaves of one group (a
source) in order form a tree: while several nodes remain, each run of `FANOUT`
consecutive ones becomes the digest of their joined hexadecimal digests.  What
remains is the group's subroot, and the subroots in order of their groups form
a tree of the same kind whose last node is the root.

Only every `LEVELS_KEPT`-th level is written (`Manifest`): an aligned subtree of
16^3 nodes becomes one row of the next written level.  A proof takes subtrees
from the top down.  Each is regenerated from the nodes of its lowest level, hands
the siblings on the way up to the nodes below, and is forgotten; so no task ever
holds more than one subtree, whatever the size of a group.

Positions come from range partitions over group, order columns, leaf digest and
row number, so a group or a set of equal rows of any size is spread over tasks.

Nulls: a null column is ``-`` in a leaf; a null group is a group of its own, the
first.  A null order value comes first.  Empty texts are values of no bytes.
Rows that repeat are leaves each; equal leaves are interchangeable.  An empty
table has no groups, no root and no proofs.  Only the named columns are read, so
others may have any name.  Texts of any length are hashed in the scan and not
moved.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.scratch import need, stored

FANOUT = 16
LEVELS_KEPT = 3
#: Nodes of one written level under one node of the next.
SPAN = FANOUT ** LEVELS_KEPT

_SIBLING = pa.struct([("left", pa.string()), ("right", pa.string())])
_ABOVE = "array<struct<left: string, right: string>>"
_NODE = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("total", pa.int64()), ("digest", pa.string())])


@dataclass(frozen=True)
class Manifest:
    """The written part of all trees.

    ``levels[k]`` holds level ``k * LEVELS_KEPT`` of the group trees that reach
    it with more than one node (all leaves for k = 0, with ``row_id`` and the
    ``changed`` leaf): key, pos, total (nodes of that level in the group), digest.
    ``subroots`` has key, leaves, digest per group, ``top`` the levels of the tree
    over the groups, ``root`` its one row: digest.
    """

    levels: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: DataFrame


def leaf_digest(*columns: Column) -> Column:
    """Digest of the columns' bytes, each led by its length; ``-`` for null."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _parent(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def _subtree(digests: list[str], total: int) -> list[list[str]]:
    """The levels of an aligned subtree, lowest first, up to its top node.

    ``total`` is the size of the lowest level in the whole tree: a tree that
    ends within the subtree stops at its last node.
    """
    levels = [digests]
    for _ in range(LEVELS_KEPT):
        if total <= 1:
            break
        below = levels[-1]
        levels.append([_parent(below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
        total = -(-total // FANOUT)
    return levels


def _columns(table: pa.Table, *names: str) -> list[list]:
    return [table.column(n).to_pylist() for n in names]


def _raise(table: pa.Table) -> pa.Table:
    """The top node of one subtree."""
    keys, places, totals, digests = _columns(table.sort_by("pos"), "key", "pos", "total", "digest")
    top = _subtree(digests, totals[0])[-1][0]
    return pa.Table.from_arrays(
        [pa.array([v], t) for v, t in zip((keys[0], places[0] // SPAN, -(-totals[0] // SPAN), top), _NODE.types, strict=True)],
        schema=_NODE)


def _chunk() -> Column:
    return F.floor(F.col("pos") / SPAN).cast("long").alias("chunk")


def _levels(nodes: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The written levels above ``nodes`` and the last node of each tree: key, digest."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    levels, ends = [nodes], []
    while True:
        raised = levels[-1].select("key", "pos", "total", "digest").groupBy("key", _chunk()).applyInArrow(
            _raise, "key string, pos long, total long, digest string")
        above = stored(raised, label)
        ends.append(above.where("total = 1").select("key", "digest"))
        most = -(-most // SPAN)
        if most <= 1:
            break
        levels.append(above.where("total > 1"))
    last = ends[0]
    for end in ends[1:]:
        last = last.union(end)
    return levels, last


def _placed(rows: DataFrame, order_by: Sequence[Column], label: str) -> DataFrame:
    """The stored ``rows`` with pos (from 0 within key) and total (rows of the key)."""
    numbered = rows.withColumn("number", F.monotonically_increasing_id())
    spread = numbered.repartitionByRange("key", *order_by, "number").sortWithinPartitions("key", *order_by, "number")
    cut = stored(spread.drop("number").withColumn("part", F.spark_partition_id()).withColumn(
        "local", F.monotonically_increasing_id()), label)
    parts = cut.groupBy("key", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("local").alias("start"))
    before = W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        "key", "part", "start", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
        F.sum("rows").over(W.partitionBy("key")).alias("total"))
    # A group's rows in one partition are few enough for a task, so this join has no hot key.
    return cut.join(offsets, ["key", "part"]).withColumn(
        "pos", F.col("offset") + F.col("local") - F.col("start")).drop("part", "local", "start", "offset")


def build_manifest(
    docs: DataFrame,
    leaf: Column,
    changed: Column | None = None,
    group: str = "source",
    id_col: str = "doc_id",
) -> Manifest:
    """Write the trees over ``docs``, groups by ``group``, leaves by ``id_col``.

    ``changed``, if given, is a leaf to hold against the manifest where it is
    not null; it takes no part in the trees.
    """
    need(docs, [group, id_col])
    # The key keeps the order of the groups, null first.
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = stored(docs.select(
        key.alias("key"), F.col(id_col).cast("long").alias("row_id"), leaf.alias("digest"),
        (F.lit(None).cast("string") if changed is None else changed).alias("changed")), "leaves")
    placed = stored(_placed(leaves, [F.col("row_id").asc_nulls_first(), F.col("digest")], "ordered"), "placed")
    levels, subroots = _levels(placed, "level")
    subroots = stored(subroots.join(placed.groupBy("key").agg(F.count(F.lit(1)).alias("leaves")), "key"), "subroots")
    groups = subroots.select(F.col("key").alias("source_key"), "digest", F.lit("").alias("key"))
    top = stored(_placed(groups, [F.col("source_key")], "groups"), "top")
    above, root = _levels(top, "top_level")
    return Manifest(levels, subroots, above, root.select("digest"))


def _siblings(levels: list[list[str]]) -> list[list[tuple[str, str]]]:
    """For each level below the top, the joined siblings before and after each node."""
    out = []
    for nodes in levels[:-1]:
        found = []
        for at in range(0, len(nodes), FANOUT):
            run = nodes[at:at + FANOUT]
            found += [("".join(run[:i]), "".join(run[i + 1:])) for i in range(len(run))]
        out.append(found)
    return out


def _ways(digests: list[str], total: int, above: list[tuple[str, str]]) -> Iterator[list[tuple[str, str]]]:
    """For each node of a subtree's lowest level, its siblings up to the root."""
    beside = _siblings(_subtree(digests, total))
    ways = [above]
    for found in reversed(beside):
        ways = [[own, *ways[i // FANOUT]] for i, own in enumerate(found)]
    # A subtree of one node has no level below its top.
    return iter(ways)


def _above(table: pa.Table) -> list[tuple[str, str]]:
    return [(s["left"], s["right"]) for s in table.column("above")[0].as_py()]


def _descend(nodes: DataFrame, parents: DataFrame, extra: str | None = None) -> DataFrame:
    """key, pos, above for the nodes of a written level; ``parents`` has it for their subtrees (key, chunk)."""
    kept = ["key", "pos"] if extra is None else [extra]

    def walk(own: pa.Table, parent: pa.Table) -> pa.Table:
        own = own.sort_by("pos")
        digests, totals = _columns(own, "digest", "total")
        ways = [[{"left": a, "right": b} for a, b in way] for way in _ways(digests, totals[0], _above(parent))]
        return own.select(kept).append_column("above", pa.array(ways, pa.list_(_SIBLING)))

    own = nodes.select("*", _chunk()).groupBy("key", "chunk")
    schema = "key string, pos long" if extra is None else f"{extra} string"
    return own.cogroup(parents.groupBy("key", "chunk")).applyInArrow(walk, f"{schema}, above {_ABOVE}")


def _rounds(total: str) -> Column:
    """Index of the highest written level of a tree by its number of leaves."""
    level, nodes = F.lit(0), F.col(total)
    for _ in range(5):  # 16^18 leaves
        nodes = F.ceil(nodes / SPAN)
        level = level + F.when(nodes > 1, 1).otherwise(0)
    return level


def _group_ways(manifest: Manifest) -> DataFrame:
    """key, level, above: the siblings of each subroot, and where its tree ends."""
    start = manifest.top[0].sparkSession.createDataFrame([("", 0, [])], f"key string, chunk long, above {_ABOVE}")
    parents = start
    for nodes in reversed(manifest.top[1:]):
        parents = stored(_descend(nodes, parents), "ways").withColumnRenamed("pos", "chunk")
    ways = _descend(manifest.top[0], parents, "source_key").withColumnRenamed("source_key", "key")
    ended = manifest.subroots.select("key", _rounds("leaves").alias("level"))
    return stored(ways.join(ended, "key"), "group_ways")


_PROOF = ("row_id long, key string, leaf string, proof_sha256 string, folded_root string, "
          "siblings array<struct<left: string, right: string>>")


def proofs(manifest: Manifest, with_siblings: bool = False) -> DataFrame:
    """The inclusion proof of every leaf.

    row_id, leaf, subroot, root; ``siblings``, if asked for, is the proof itself:
    what stands before and after the node on each level from leaf to root.
    ``proof_sha256`` is the digest of all of them joined.  ``folded_root`` is
    recomputed from the changed leaf, or the leaf where none is given, and
    ``verified`` tells whether that is the root.
    """
    groups = _group_ways(manifest)

    def parents_of(level: int, above: DataFrame | None) -> DataFrame:
        here = groups.where(F.col("level") == level).select("key", F.lit(0).cast("long").alias("chunk"), "above")
        return here if above is None else here.unionByName(above.withColumnRenamed("pos", "chunk"))

    above = None
    for level in range(len(manifest.levels) - 1, 0, -1):
        above = stored(_descend(manifest.levels[level], parents_of(level, above)), "ways")

    def extract(own: pa.Table, parent: pa.Table) -> pa.Table:
        own = own.sort_by("pos")
        digests, totals, changed = _columns(own, "digest", "total", "changed")
        proved, folded, listed = [], [], []
        for leaf, other, way in zip(digests, changed, _ways(digests, totals[0], _above(parent)), strict=True):
            proved.append(_parent([part for pair in way for part in pair]))
            node = leaf if other is None else other
            for left, right in way:
                node = _parent([left, node, right])
            folded.append(node)
            listed.append([{"left": a, "right": b} for a, b in way] if with_siblings else None)
        return pa.Table.from_arrays(
            [own.column("row_id"), own.column("key"), own.column("digest"), pa.array(proved, pa.string()),
             pa.array(folded, pa.string()), pa.array(listed, pa.list_(_SIBLING))],
            names=["row_id", "key", "leaf", "proof_sha256", "folded_root", "siblings"])

    leaves = manifest.levels[0].select("*", _chunk()).groupBy("key", "chunk")
    found = leaves.cogroup(parents_of(0, above).groupBy("key", "chunk")).applyInArrow(extract, _PROOF)
    # One root for all rows; the subroots are one row per group.
    root = manifest.root.first()
    out = found.join(manifest.subroots.select("key", F.col("digest").alias("subroot")), "key").select(
        "row_id", "leaf", "subroot", F.lit(root.digest if root else None).cast("string").alias("root"), "proof_sha256",
        "folded_root", F.col("folded_root").eqNullSafe(F.lit(root.digest if root else None)).alias("verified"),
        *(["siblings"] if with_siblings else []))
    return out


_LEVELS_IN_SQL = 8  # 16^8 leaves


def manifest_sql() -> str:
    """DuckDB SQL of the driver query: all levels of all trees, siblings by self-joins of single runs."""
    def field(column: str) -> str:
        return f"coalesce(octet_length(encode({column}::varchar))::varchar || ':' || {column}::varchar, '-')"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    parts = [f"""
with recursive crc as (
  select i::bigint as v, i::bigint as c, 0 as k from range(256) t(i)
  union all
  select v, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from crc where k < 8
), bytes as (select list(c order by v) as t from crc where k = 8
), docs as (
  select doc_id, coalesce('=' || source, '') as key, sha256({head} || {field("text")}) as leaf,
    sha256({head} || {field(lowered)}) as other,
    xor(list_reduce(list_prepend(4294967295::bigint, [ascii(x)::bigint for x in string_split(doc_id::varchar, '')]),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 5 = 0 as tampered
  from documents, bytes
), l0 as (
  select *, row_number() over (partition by key order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by key) as total from docs
), n0 as (select key, pos, total, leaf as digest from l0)"""]

    def climb(name: str) -> list[str]:
        out = []
        for k in range(_LEVELS_IN_SQL):
            out.append(f"""
{name}{k + 1} as (
  select key, pos // 16 as pos, (min(total) + 15) // 16 as total, sha256(string_agg(digest, '' order by pos)) as digest
  from {name}{k} where total > 1 group by key, pos // 16
)""")
            out.append(f"""
{name}s{k} as (
  select a.key, a.pos, coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos < a.pos), '') as l,
    coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos > a.pos), '') as r
  from {name}{k} a join {name}{k} b on a.key = b.key and a.pos // 16 = b.pos // 16
  where a.total > 1 group by a.key, a.pos
)""")
        return out

    def ends(name: str) -> str:
        return " union all ".join(f"select key, digest from {name}{k} where total = 1" for k in range(_LEVELS_IN_SQL + 1))

    parts += climb("n")
    parts.append(f"\nsubroots as ({ends('n')})")
    parts.append("""
t0 as (
  select '' as key, key as own, row_number() over (order by key) - 1 as pos, count(*) over () as total, digest from subroots
)""")
    parts += climb("t")
    parts.append(f"\nroots as ({ends('t')})")
    fold, proof, joins = "case when tampered then coalesce(other, leaf) else leaf end", [], []
    for name, base, key in (("n", "d.pos", "d.key"), ("t", "g.pos", "''")):
        for k in range(_LEVELS_IN_SQL):
            s = f"{name}x{k}"
            joins.append(f"left join {name}s{k} {s} on {s}.key = {key} and {s}.pos = {base} // {16 ** k}")
            proof.append(f"coalesce({s}.l || {s}.r, '')")
    # Folding goes level by level, each from a table, so that no expression is written out twice.
    wide = ", ".join(f"{n}x{k}.l as {n}l{k}, {n}x{k}.r as {n}r{k}" for n in "nt" for k in range(_LEVELS_IN_SQL))
    parts.append(f"""
w0 as (
  select d.doc_id, d.leaf, u.digest as subroot, (select digest from roots) as root,
    sha256({' || '.join(proof)}) as proof_sha256, {fold} as f, {wide}
  from l0 d join subroots u on u.key = d.key join t0 g on g.own = d.key
  {' '.join(joins)}
)""")
    at = 0
    for n in "nt":
        for k in range(_LEVELS_IN_SQL):
            parts.append(f"""
w{at + 1} as (
  select * replace (case when {n}l{k} is null then f else sha256({n}l{k} || f || {n}r{k}) end as f) from w{at}
)""")
            at += 1
    return ",".join(parts) + f"""
select doc_id, leaf, subroot, root, proof_sha256, f as folded_root, f = root as verified from w{at}"""
