"""Documents to question, answer and reasoning records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators import curation as C
from lectern.operators.model_stage import AnswerStore, apply_error_policy
from lectern.operators.relational import input_prefix
from lectern.sources.batches import checkpointed_batches


#: Batches that go through the steps as one table, and such groups side by side: a step then has
#: enough rows for a cluster, and one group's steps run while another waits for the driver.
BATCHES_TOGETHER, GROUPS_AT_ONCE = 32, 4


@dataclass(frozen=True)
class SynthesisModels:
    select_documents: C.Model
    extract_topics: C.Model
    judge_topics: C.Model
    generate_qa: C.Model
    hindsight_reasoning: C.Model
    dispatch: C.Model | None = None


@dataclass(frozen=True)
class TopicModels:
    select_documents: C.Model
    extract_topics: C.Model


def topic_table(
    docs: DataFrame,
    models: SynthesisModels | TopicModels,
    work: str,
    concurrency: int | None = None,
    store: AnswerStore | None = None,
) -> DataFrame:
    """Topics of the useful documents, one row each; a failed call stops the run."""
    chosen = C.select_documents(
        docs.drop("text"), models.select_documents, f"{work}/documents", concurrency=concurrency, store=store
    )
    useful = apply_error_policy(chosen, "fail").where("is_useful")
    texts = docs.join(useful.select("file_path"), "file_path", "left_semi")
    extracted = C.extract_topics(
        texts, models.extract_topics, f"{work}/topics", concurrency=concurrency, store=store
    )
    return C.topic_rows(apply_error_policy(extracted, "fail"))


def records_of_topics(
    topics: DataFrame,
    models: SynthesisModels,
    work: str,
    concurrency: int | None = None,
    store: AnswerStore | None = None,
) -> DataFrame:
    """Useful topics to finished records.

    A topic whose usefulness or dispatch call failed is dropped, and so is one
    dispatched to another kind than ``qa``; without a dispatch model all topics
    are ``qa``.  A topic whose question
    call gave up yields nothing, a pair whose reasoning call gave up is dropped
    alone, and any other failure in a topic drops the whole topic.  Topics are spread
    over the tasks once, for the first step; the others read them as that one wrote them.
    """
    judged = C.judge_topics(topics, models.judge_topics, f"{work}/judged", concurrency=concurrency, store=store)
    useful = C.drop_audit(apply_error_policy(judged, "drop_row")).where("is_useful")
    typed = useful.drop("is_useful", "reason")
    if models.dispatch is not None:
        sent = C.dispatch_problem_type(
            typed, models.dispatch, f"{work}/types", concurrency=concurrency, store=store
        )
        chosen = apply_error_policy(sent, "drop_row").where(F.col("problem_type") == "qa")
        typed = C.drop_audit(chosen).drop("problem_type")
    generated = C.generate_qa(
        typed, models.generate_qa, f"{work}/qa",
        concurrency=concurrency, store=store, spread=False,
    )
    pairs = C.qa_rows(apply_error_policy(generated, "drop_row"))
    reasoned = C.hindsight_reasoning(
        pairs, models.hindsight_reasoning, f"{work}/reasoning", concurrency=concurrency, store=store, spread=False
    )
    kept = apply_error_policy(reasoned, "drop_group", "topic_key")
    return C.drop_audit(kept).where(F.col("reasoning").isNotNull())


def qra_records(
    docs: DataFrame,
    models: SynthesisModels,
    work: str,
    max_topics: int | None = None,
    batch_size: int | None = None,
    concurrency: int | None = None,
    store: AnswerStore | None = None,
) -> DataFrame:
    """The whole synthesis.  Every model step is a table under ``work``: run again
    with the same folder, it goes on where it stopped.

    ``max_topics``, if given, cuts the topics in input order before they are judged.  With
    ``batch_size`` the topics are worked off in batches of that many, groups of them side
    by side; one after the other with ``concurrency``, which bounds the calls of all
    of them, and with a ``store``, in which the next batch finds the answers of the
    last.  With a ``store`` no prompt that a model has answered before, in any run,
    is sent again.
    """
    topics = input_prefix(
        topic_table(docs, models, work, concurrency, store), max_topics, "file_pos", "topic_pos"
    )
    if batch_size is None:
        return records_of_topics(topics, models, work, concurrency, store)
    at_once, together = (GROUPS_AT_ONCE, BATCHES_TOGETHER) if concurrency is None and store is None else (1, 1)
    return checkpointed_batches(
        topics, f"{work}/batches", ["file_pos", "topic_pos"], batch_size,
        lambda batch, folder: records_of_topics(batch, models, folder, concurrency, store), [models], at_once, together,
    ).drop("batch_id")
