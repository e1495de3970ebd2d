"""Answer known questions with a model, judge the answers, report accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators import curation as C
from lectern.operators.metrics import accuracy_summary
from lectern.operators.model_stage import AnswerStore, apply_error_policy
from lectern.operators.relational import sorted_head
from lectern.sources.stages import stage_once


def evaluate_records(
    records: DataFrame,
    solver: C.Model,
    judge: C.Model,
    work: str,
    limit: int | None = None,
    concurrency: int | None = None,
    store: AnswerStore | None = None,
) -> DataFrame:
    """Judged answers of all records, or of the first ``limit`` by question.

    A record whose solving or judging failed is dropped and does not count.
    """
    chosen = sorted_head(records, limit, "question", "qa_key")
    answered = C.answer_questions(chosen, solver, f"{work}/answers", concurrency=concurrency, store=store)
    kept = C.drop_audit(apply_error_policy(answered, "drop_row"))
    with_answer = kept.where(F.col("agent_answer").isNotNull())
    judged = C.judge_answers(with_answer, judge, f"{work}/verdicts", concurrency=concurrency, store=store)
    return C.drop_audit(apply_error_policy(judged, "drop_row")).drop("reason")


def evaluation_report(judged: DataFrame, work: str) -> tuple[DataFrame, DataFrame]:
    """The written results and their accuracy."""
    results = stage_once(judged.sparkSession, f"{work}/results", lambda: judged, [judged])
    return results, accuracy_summary(results)


def verification_report(
    records: DataFrame, model: C.Model, work: str, concurrency: int | None = None,
    store: AnswerStore | None = None,
) -> DataFrame:
    """Each record with the verdict on its reasoning, and a status to print."""
    verified = C.verify_records(records, model, f"{work}/verified", concurrency=concurrency, store=store)
    checked = C.drop_audit(apply_error_policy(verified, "fail"))
    # The two status texts.
    status = F.when(F.col("is_valid"), F.lit("✅ [VALID]")).otherwise(F.lit("❌ [INVALID]"))
    return checked.select(
        "qa_key", "question", "reasoning", "answer", status.alias("status"), "feedback"
    )
