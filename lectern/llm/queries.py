"""Driver queries of the llm operators and their DuckDB SQL, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.decontamination import contamination, contamination_sql
from lectern.llm.jaccard_join import jaccard_components
from lectern.llm.language_id import identify
from lectern.llm.license_scan import license_scan, license_scan_sql
from lectern.llm.line_dedup import dropped_lines
from lectern.llm.merkle import build_manifest, leaf_digest, manifest_sql, proofs
from lectern.llm.mixing import mixed, mixing_sql
from lectern.llm.packing import packed
from lectern.llm.periodic_runs import periodic_runs
from lectern.llm.quality import quality_scores
from lectern.llm.suffix_dedup import without_repeats
from lectern.llm.token_counts import token_counts
from lectern.llm.vector_search import top_k


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents")).withColumnRenamed("row_id", "doc_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scores.withColumnRenamed("row_id", "doc_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(_table(spark, sf_dir, "documents")).withColumnRenamed("row_id", "doc_id")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = without_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return spans.select(
        F.col("row_id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = dropped_lines(docs)
    ids = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"))
    return ids.join(found, "row", "left").select(
        "doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(_table(spark, sf_dir, "documents"), model).withColumnRenamed("row_id", "doc_id")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(_table(spark, sf_dir, "documents"))
    return found.select(F.col("row_id").alias("doc_id"), F.array_join("sequence", ",").alias("sequence"),
                        F.array_join("licenses", ",").alias("licenses"))


def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents")).withColumnRenamed("row_id", "doc_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row_id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def loop_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document, by its id's checksum, repeat from some place on."""
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_table(spark, sf_dir, "documents"), rewrite=loop_words)
    # The greatest length, then the smallest start and period.
    order = F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(order)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select("*", best.alias("best")).select(
        F.col("row_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packed(_table(spark, sf_dir, "documents"), tokenizer, end_id=2).withColumnRenamed("row_id", "doc_id")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tampered leaf of a row differs in the case of its text alone."""
    docs = _table(spark, sf_dir, "documents")
    about = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    manifest = build_manifest(
        docs, leaf_digest(*about, F.col("text")), F.when(tampered, leaf_digest(*about, lowered)))
    return proofs(manifest).withColumnRenamed("row_id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_quality": op2_quality,
    "op3_mixing": op3_mixing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_license_scan": op7_license_scan,
    "op8_vector_search": op8_vector_search,
    "op9_language_id": op9_language_id,
    "op10_decontamination": op10_decontamination,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_packing": op13_packing,
}

ORACLES: dict[str, str] = {
    "op3_mixing": mixing_sql(),
    "op7_license_scan": license_scan_sql(),
    "op10_decontamination": contamination_sql(),
    "op12_merkle_manifest": manifest_sql(),
    "op8_vector_search": """
with v as (
  select vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as t
  from embeddings
  where embedding is not null and vec_id is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum([p[1] * p[2] for p in list_zip(q.t, c.t)]) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5""",
}
