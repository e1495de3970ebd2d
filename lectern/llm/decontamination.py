"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

An item's windows are its runs of 10 words; a shorter item is one window.  A
window is the set of its placed 3-word shingles, and occurs in a document where
all of them are found in place.

1. Documents' shingles that any window has are found in one scan.
2. Shingles are ordered by how often they were found.  A window needs all of its
   shingles, so its prefix is one: the rarest.  A window with a shingle that was
   never found is out.
3. Only finds of a prefix shingle become candidates; the window must lie within
   the document from there (position and length bounds).
4. A candidate counts if each of its shingles was found at its place.

Null texts have no words; items without words have no window.  Repeated rows
each get a row.  Equal windows of several items are looked for once.  Items with
a null id count for hits and number, but are not among the listed ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.scratch import need, stored

WINDOW, SHINGLE = 10, 3
#: Distinct window shingles up to which the scan's join is broadcast; beyond, it is shuffled.
BROADCAST_ROWS = 300_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Words after lower-casing A-Z alone."""
    value = F.col(text).cast("string")
    # In a text of one-byte characters lower() does just that, and faster.
    lowered = F.when(F.octet_length(value) == F.char_length(value), F.lower(value)).otherwise(F.translate(value, _UPPER, _LOWER))
    return F.coalesce(F.array_remove(F.split(lowered, _BETWEEN), ""), F.array().cast("array<string>"))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """item, words: the distinct windows of each item."""
    words = items.select(F.col(id_col).cast("string").alias("item"), words_of(text_col).alias("all")).where("size(all) > 0")
    length = F.least(F.lit(window), F.size("all"))
    starts = F.sequence(F.lit(1), F.size("all") - length + 1)
    return words.withColumn("length", length).withColumn("start", F.explode(starts)).select(
        "item", F.slice("all", F.col("start"), F.col("length")).alias("words")).distinct()


def _hash_at(words: str, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(F.col(words), at + k) for k in range(size)])


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """window, length, size (of its shingles), place, hash, shingle for each shingle of each window."""
    size = F.least(F.lit(shingle), F.col("length"))
    placed = windows.select("window", "words", F.size("words").alias("length")).withColumn("size", size).withColumn(
        "place", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("size"))))
    hashed = reduce(lambda acc, s: acc.when(F.col("size") == s, _hash_at("words", F.col("place"), s)),
                    range(2, shingle + 1), F.when(F.col("size") == 1, _hash_at("words", F.col("place"), 1)))
    return placed.select("window", "length", "size", "place", hashed.alias("hash"),
                         F.array_join(F.slice("words", F.col("place") + 1, F.col("size")), " ").alias("shingle"))


def _finds(rows: DataFrame, shingles: DataFrame, size: int, broadcast: bool) -> DataFrame:
    """row, row_id, n_words, pos, hash, size for every place with a window shingle;
    the first place of a document comes in any case, to carry its length."""
    wanted = shingles.where(F.col("size") == size).select(F.col("hash").alias("wanted"), "shingle")
    hashes = F.transform("words", lambda _, i: _hash_at("words", i, size))
    places = rows.select("row", "row_id", "words", F.posexplode_outer(hashes).alias("pos", "hash"))
    text = F.array_join(F.slice("words", F.col("pos") + 1, size), " ")
    if not broadcast:
        # Shuffled: a place takes its own few words along, not those of its document.
        places = places.select("row", "row_id", F.size("words").cast("long").alias("n_words"), "pos", "hash", text.alias("own"))
        found = places.join(wanted, (F.col("hash") == F.col("wanted")) & (F.col("own") == F.col("shingle")), "left")
        return found.where("wanted is not null or coalesce(pos, 0) = 0").select(
            "row", "row_id", "n_words", "pos", F.when(F.col("wanted").isNotNull(), F.col("hash")).alias("hash"),
            F.lit(size).alias("size"))
    found = places.join(F.broadcast(wanted), (F.col("hash") == F.col("wanted")) & (text == F.col("shingle")), "left")
    return found.where("wanted is not null or coalesce(pos, 0) = 0").select(
        "row", "row_id", F.size("words").cast("long").alias("n_words"), "pos",
        F.when(F.col("wanted").isNotNull(), F.col("hash")).alias("hash"), F.lit(size).alias("size"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """row_id, n_words, n_hit, n_items, items (sorted ids), contaminated for every row of ``docs``."""
    need(docs, [id_col, text_col])
    need(items, [item_col, item_text])
    owned = stored(item_windows(items, item_col, item_text).withColumn("window", F.array_join("words", " ")), "windows")
    windows = owned.select("window", "words").distinct()
    parts = stored(window_shingles(windows), "shingles")
    shingles = stored(parts.select("hash", "shingle", "size").distinct(), "wanted")
    sizes = [r["size"] for r in shingles.select("size").distinct().orderBy("size").collect()] or [SHINGLE]  # at most SHINGLE
    small = shingles.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = docs.select(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string")).alias("row"),
                       F.col(id_col).cast("long").alias("row_id"), words_of(text_col).alias("words"))
    finds = stored(reduce(DataFrame.unionByName, [_finds(rows, shingles, s, small) for s in sizes]), "finds")
    placed = stored(finds.where("hash is not null").select("row", "n_words", "pos", "hash", "size").distinct(), "placed")
    counts = placed.groupBy("hash", "size").agg(F.count(F.lit(1)).alias("found"))
    prefixes = (
        parts.join(counts, ["hash", "size"], "left").groupBy("window", "length", "size")
        .agg(F.min(F.struct(F.coalesce("found", F.lit(0)).alias("found"), "hash", "place")).alias("rarest"))
        .where("rarest.found > 0")
        .select("window", "length", "size", F.col("rarest.hash").alias("hash"), F.col("rarest.place").alias("place"))
    )
    candidates = (
        placed.join(prefixes, ["hash", "size"]).withColumn("start", F.col("pos") - F.col("place"))
        .where("start >= 0 and start + length <= n_words").select("row", "window", "length", "size", "start")
    )
    checked = candidates.join(parts.select("window", "place", F.col("hash").alias("due")), "window").select(
        "row", "window", "length", "size", "start", (F.col("start") + F.col("place")).alias("pos"), F.col("due").alias("hash"))
    hits = stored(
        checked.join(placed.select("row", "pos", "hash", "size"), ["row", "pos", "hash", "size"])
        .groupBy("row", "window", "start", "length", "size").agg(F.count(F.lit(1)).alias("met"))
        .where("met = length - size + 1").select("row", "window", "start", "length"), "hits")
    covered = (
        hits.select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("at"))
        .distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    named = (
        hits.select("row", "window").distinct().join(owned.select("window", "item"), "window").select("row", "item").distinct()
        .groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    )
    lengths = finds.where(F.coalesce("pos", F.lit(0)) == 0).where(F.col("size") == sizes[0]).select("row", "row_id", "n_words")
    return lengths.join(covered, "row", "left").join(named, "row", "left").select(
        "row_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


def contamination_sql(documents: str = "documents", benchmark: str = "benchmark") -> str:
    """The same digest in DuckDB SQL."""
    split = (r"list_filter(regexp_extract_all(translate(coalesce(text, ''), '" + _UPPER + "', '" + _LOWER
             + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
    return f"""
with d as (select doc_id, row_number() over () as row, {split} as w from {documents}),
b as (select item_id, {split} as w from {benchmark}),
n as (
  select distinct item_id, least({WINDOW}, len(w)) as length, list_slice(w, s, s + least({WINDOW}, len(w)) - 1) as win
  from (select *, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) as s from b where len(w) > 0)
),
runs as (
  select row, s, length, list_slice(w, s, s + length - 1) as win
  from (select d.*, l.length, unnest(range(1, greatest(0, len(w) - l.length + 1) + 1)) as s
        from d, (select distinct length from n) l)
),
hit as (select distinct row, s, length, item_id from runs join n using (length, win)),
cov as (select row, count(distinct p) as n_hit from (select row, unnest(range(s, s + length)) as p from hit) group by row),
it as (select row, count(distinct coalesce(cast(item_id as varchar), '?')) as n_items,
              string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hit group by row)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from d left join cov using (row) left join it using (row)"""
