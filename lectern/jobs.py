"""Jobs for ``spark-submit``: one sub-command per workflow.

Model steps take ``--model package.module:name``, where the name is a mapping
from step to ``CallableModel`` or ``RecordedModel``, or a function of the
session that returns one.  Inputs may be folders or patterns; outputs are
folders that are replaced.
"""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import schemas as S
from lectern.operators.metrics import accuracy_text, counted, stage_funnel
from lectern.operators.model_stage import AnswerStore
from lectern.operators.positions import with_position
from lectern.operators.records import as_prompt_completion, solve_results
from lectern.plans import evaluation, synthesis, training, trending
from lectern.plans import exam_set as exam_plan
from lectern.session import apply_runtime_settings, path_exists
from lectern.sources import corpus, csv_tables, json_records, training_sets
from lectern.sources.identity import Files
from lectern.sources.stages import stage_once

EXAM_BATCH = 1_000
KEYED_QRA = T.StructType([T.StructField("qa_key", T.StringType(), False), *S.QRA.fields])


def load_model(spark: SparkSession, spec: str) -> Mapping:
    module, _, name = spec.partition(":")
    found = getattr(importlib.import_module(module), name)
    return found if isinstance(found, Mapping) else found(spark)


def answer_store(args: argparse.Namespace) -> AnswerStore | None:
    return AnswerStore(args.answers) if args.answers else None


def load_records(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Records with a ``qa_key``: our own lines, or documents ``{"problems": [...]}``.

    A record of a document is named by its file and place in it, padded so that
    the order of the names is that of the records.
    """
    if layout == "lines":
        return json_records.load_json_lines(spark, path, KEYED_QRA)
    rows = json_records.load_json_document(spark, path, S.QRA)
    key = F.concat_ws("#", "source_file", F.lpad(F.col("pos").cast("string"), 9, "0"))
    return rows.withColumn("qa_key", key).select(*KEYED_QRA.names)


def load_documents(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """file_path, text and file_pos of the documents, in one pass over the small files."""
    read = corpus.read_packed if args.documents_as == "packed" else corpus.read_texts
    texts = stage_once(
        spark, f"{args.work}/texts", lambda: read(spark, args.documents), [Files(spark, (args.documents,)), args.documents_as]
    )
    order = with_position(texts.select("file_path"), ["file_path"], f"{args.work}/files", "file_pos")
    return texts.join(order, "file_path")


def document_stages(spark: SparkSession, work: str) -> dict[str, DataFrame]:
    """What the steps up to the topics have written."""
    chosen, extracted = spark.read.parquet(f"{work}/documents"), spark.read.parquet(f"{work}/topics")
    return {
        "documents": chosen, "useful_documents": chosen.where("is_useful"),
        "extracted_topics": extracted.select(F.explode("topics").alias("topic"))}


def report(spark: SparkSession, work: str, written: Mapping[str, DataFrame], observed: Mapping[str, int]) -> DataFrame:
    """Rows by stage, kept under ``WORK/counts``.

    ``written`` are tables that lie there already, so that no step runs again to be
    counted; ``observed`` were counted while they were written.
    """
    last = len(written)
    rows = [(last + place, name, n) for place, (name, n) in enumerate(observed.items())]
    seen = spark.createDataFrame(rows, "stage_pos int, stage string, rows long")
    counts = stage_funnel(**written).unionByName(seen).orderBy("stage_pos")
    counts.coalesce(1).write.mode("overwrite").json(f"{work}/counts")
    return load_counts(spark, work)


def load_counts(spark: SparkSession, work: str) -> DataFrame:
    return spark.read.schema("stage_pos int, stage string, rows long").json(f"{work}/counts").orderBy("stage_pos")


def rank_packages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    tables = trending.load_registry(spark, args.dump, args.work, args.splittable)
    best = trending.trending_packages(
        tables["crates"], tables["crate_downloads"], tables["dependencies"], tables["versions"],
        cutoff=args.cutoff, top=args.top,
    )
    csv_tables.write_csv(best.coalesce(1), args.out)
    return best


def synthesise(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    model = load_model(spark, args.model)
    steps = [
        model[s] for s in (
            "select_documents", "extract_topics", "judge_topics", "generate_qa",
            "hindsight_reasoning",
        )
    ]
    made = synthesis.qra_records(
        load_documents(spark, args), synthesis.SynthesisModels(*steps), args.work,
        args.max_topics, args.batch_size, args.concurrency, answer_store(args),
    )
    saved, seen = counted(made.select(*KEYED_QRA.names), "records")
    json_records.save_json_lines(saved, args.out)
    report(spark, args.work, document_stages(spark, args.work), {"records": seen.get["rows"]})
    return made


def load_topics(spark: SparkSession, path: str, work: str) -> DataFrame:
    """Topics of a document ``{"topics": [{"file_path": ..., "topic": {...}}]}``."""
    rows = json_records.load_json_document(spark, path, S.TOPIC_ENTITY, root="topics").select(
        F.col("source_file").alias("file_pos"), "pos", "file_path", "topic.title", "topic.description")
    return exam_plan.keyed_topics(rows, work).drop("pos")


def load_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Outcomes so far; none while the generator has not written any."""
    if path_exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], S.EXAM_OUTCOME)


def build_exams(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """From documents, or a finished topics document, to the exam table and the queue of waiting topics.

    Outcomes are a Parquet table by ``topic_key``, as ``exam_set`` describes it, to which the
    generator of exams adds.  ``WORK/waiting`` has the topics still without one, in batches (one
    folder each).  Run again, the job calls no model for what it has judged, takes the outcomes
    that have come since and writes both tables anew.
    """
    model, store = load_model(spark, args.model), answer_store(args)
    outcomes = load_outcomes(spark, args.outcomes)
    if args.documents:
        docs = load_documents(spark, args)
        two = synthesis.TopicModels(model["select_documents"], model["extract_topics"])
        topics = synthesis.topic_table(docs, two, args.work, args.concurrency, store)
        stages = document_stages(spark, args.work)
    else:
        topics, stages = load_topics(spark, args.topics, args.work), {}
    useful = exam_plan.useful_topics(topics, model["judge_topics"], args.work, args.max_topics, args.concurrency, store)
    made = exam_plan.exams_of(useful, outcomes, F.lit(args.image))
    exams = stage_once(spark, f"{args.work}/exams", lambda: made, [made])
    csv_tables.write_csv(exams.select(*S.EXAM_ROW.names), args.out)
    waiting, seen = counted(exam_plan.waiting_topics(useful, outcomes, args.work, args.batch_size), "waiting")
    waiting.repartition("batch_id").write.mode("overwrite").partitionBy("batch_id").parquet(f"{args.work}/waiting")
    report(spark, args.work, {
        **stages, "topics": topics, "useful_topics": useful, "exams": exams.where("status = 'generated'"),
        "failed_exams": exams.where("status <> 'generated'"),
        "outcomes_of_no_topic": exam_plan.unknown_outcomes(topics, outcomes)}, {"waiting": seen.get["rows"]})
    return exams.groupBy("status").count()


def evaluate(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    model = load_model(spark, args.model)
    judged = evaluation.evaluate_records(
        load_records(spark, args.records, args.layout), model["answer_questions"],
        model["judge_answers"], args.work, args.limit, args.concurrency, answer_store(args),
    )
    results, summary = evaluation.evaluation_report(judged, args.work)
    json_records.save_json_lines(solve_results(results), args.out)
    return summary.withColumn("accuracy", accuracy_text(F.col("accuracy")))


def verify(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    model = load_model(spark, args.model)
    report = evaluation.verification_report(
        load_records(spark, args.records, args.layout), model["verify_records"], args.work,
        args.concurrency, answer_store(args),
    )
    json_records.save_json_lines(report, args.out)
    return report.groupBy("status").count()


def build_training_set(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    records = load_records(spark, args.records, args.layout)
    if args.form == "completions":
        built = as_prompt_completion(records)
    else:
        built = training.training_set(records, "qa_key", args.max_length, args.on_exceed)
        built = built.drop("qa_key")
    training_sets.write_training_set(built, args.out)
    return training_sets.read_training_set(spark, args.out)


def build_rollouts(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Outcomes are a Parquet table of ``id``, ``attempt`` and ``success``."""
    exams = csv_tables.read_csv_strict(spark, args.exams, S.EXAM_ROW)
    outcomes = spark.read.parquet(args.outcomes)
    made = training.rollout_set(
        exams, outcomes, args.image, args.project_dir, args.library_dir, n=args.attempts
    )
    made.write.mode("overwrite").parquet(args.out)
    return spark.read.schema(made.schema).parquet(args.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lectern.jobs")
    commands = top.add_subparsers(required=True)

    def as_documents(sub):
        sub.add_argument("--documents-as", choices=["files", "packed"], default="files", help="packed: JSON lines of file_path and text")

    def command(name, job, *needed, model=False, records=False):
        sub = commands.add_parser(name)
        sub.set_defaults(job=job)
        for option in (*needed, "out"):
            sub.add_argument(f"--{option}", required=True)
        if model:
            sub.add_argument("--model", required=True)
            sub.add_argument("--work", required=True)
            sub.add_argument("--concurrency", type=int)
            sub.add_argument("--answers", help="folder of answers kept from run to run")
        if records:
            sub.add_argument("--records", required=True)
            sub.add_argument("--layout", choices=["documents", "lines"], default="documents")
        return sub

    rank = command("rank-packages", rank_packages, "dump", "work")
    rank.add_argument("--cutoff", default=trending.CUTOFF)
    rank.add_argument("--splittable", nargs="*", default=["crate_downloads", "dependencies", "versions"])
    rank.add_argument("--top", type=int, default=trending.TOP)
    make = command("synthesise", synthesise, "documents", model=True)
    as_documents(make)
    make.add_argument("--max-topics", type=int)
    make.add_argument("--batch-size", type=int)
    solve = command("evaluate", evaluate, model=True, records=True)
    solve.add_argument("--limit", type=int)
    command("verify", verify, model=True, records=True)
    train = command("training-set", build_training_set, records=True)
    train.add_argument("--form", choices=["conversations", "completions"], default="conversations")
    train.add_argument("--max-length", type=int, default=training.MAX_TRAINING_LENGTH)
    train.add_argument("--on-exceed", choices=["drop", "error"], default="error")
    examine = command("exam-set", build_exams, "outcomes", "image", model=True)
    given = examine.add_mutually_exclusive_group(required=True)
    given.add_argument("--documents", help="folder of documents, from which topics are made")
    given.add_argument("--topics", help="finished topics document")
    as_documents(examine)
    examine.add_argument("--max-topics", type=int)
    examine.add_argument("--batch-size", type=int, default=EXAM_BATCH, help="waiting topics in a batch")
    roll = command("rollouts", build_rollouts, "exams", "outcomes", "image", "project-dir", "library-dir")
    roll.add_argument("--attempts", type=int, default=training.ROLLOUTS_PER_TASK)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    args = parser().parse_args(argv)
    session = spark or SparkSession.builder.appName("lectern").getOrCreate()
    apply_runtime_settings(session)
    result = args.job(session, args)
    result.show(25, truncate=100)
    work = getattr(args, "work", None)
    if work and path_exists(session, f"{work}/counts"):
        load_counts(session, work).show(25, truncate=False)
    return result


if __name__ == "__main__":
    main()
