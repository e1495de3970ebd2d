"""The model-backed steps from documents to verified records.

Each step renders a prompt, runs the model stage, reads the typed response and
writes the result under ``path``.  The instructions are defaults and can be
replaced; each must name the same fields.  A prompt ends with the record key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import schemas as S
from lectern.functions.nested import first_content, last_content
from lectern.functions.structured import fail_unless, parse_structured
from lectern.functions.text import render_prompt
from lectern.operators.model_stage import AnswerStore, CallableModel, RecordedModel, run_model
from lectern.operators.relational import explode_with_parent
from lectern.sources.stages import stage_once

Model = CallableModel | RecordedModel

SELECT_DOCUMENT = """\
Decide whether this documentation file helps somebody learn to use the library.
Guides for contributors, rules of conduct and lists of changes do not.
Answer as JSON: {{"is_useful": boolean}}
File path: {file_path}
Record: {key}"""

EXTRACT_TOPICS = """\
List every concept a new user of the library can learn from this document.
An empty list is right for a document that teaches nothing about using it.
Answer as JSON: {{"topics": [{{"title": string, "description": string}}]}}
File path: {file_path}
Document:
{text}
Record: {key}"""

JUDGE_TOPIC = """\
Decide whether this topic is worth an exercise for users of the library.
Features, usage and tutorials are; contribution rules, licenses, release notes,
internals and project administration are not.
Answer as JSON: {{"is_useful": boolean, "reason": string}}
Topic title: {title}
Topic description: {description}
Record: {key}"""

CHOOSE_PROBLEM_TYPE = """\
Choose how to assess this topic: "programming" for a coding task, "qa" for a
question about a concept.
Answer as JSON: {{"problem_type": string}}
Topic title: {title}
Topic description: {description}
Record: {key}"""

WRITE_QUESTIONS = """\
Write self-contained questions with answers about this topic, each on a single
mechanism and without pointing to the document.
Answer as JSON: {{"tasks": [{{"question": string, "answer": string}}]}}
File path: {file_path}
Topic title: {title}
Topic description: {description}
Record: {key}"""

EXPLAIN_ANSWER = """\
Knowing the answer, write the line of thought that leads to it from the question.
Answer as JSON: {{"reasoning": string}}
File path: {file_path}
Question: {question}
Answer: {answer}
Record: {key}"""

SOLVE_QUESTION = """\
Answer the question.
Answer as JSON: {{"items": [{{"kind": "reasoning" or "message", "content": string}}]}}
Question: {question}
Record: {key}"""

JUDGE_ANSWER = """\
Decide whether the candidate answer says the same as the known one.
Answer as JSON: {{"reason": string, "is_correct": boolean}}
Question: {question}
Known answer: {answer}
Candidate answer: {agent_answer}
Record: {key}"""

VERIFY_RECORD = """\
Decide whether the reasoning is sound and leads from the question to the answer.
Answer as JSON: {{"is_valid": boolean, "feedback": string}}
Question: {question}
Reasoning: {reasoning}
Answer: {answer}
Record: {key}"""


def ask(
    df: DataFrame,
    key: str,
    prompt: Column,
    schema: T.StructType,
    model: Model,
    path: str,
    concurrency: int | None = None,
    keep: list[str] | None = None,
    store: AnswerStore | None = None,
    spread: bool = True,
) -> DataFrame:
    """One typed model step, written to ``path``.

    The step is made from the kept columns, the prompts, the model and the
    response type: a table under ``path`` that was made from anything else is
    made again.  ``store``, if given, then still has the answers to all prompts
    that are the same.

    The written table holds the ``keep`` columns of the input (all by default),
    the response fields (null after a failure), ``attempts``, ``error`` and
    ``error_kind``; a response of the wrong type is the error kind ``invalid``.
    """
    kept = df.columns if keep is None else keep

    def build() -> DataFrame:
        answered = run_model(df, key, prompt, model, concurrency, store, spread)
        read = parse_structured(answered, "response", schema, "__parsed", "__valid")
        wrong = F.col("error").isNull() & ~F.col("__valid")
        return read.select(
            *kept,
            *[F.col(f"__parsed.{f.name}").alias(f.name) for f in schema.fields],
            "attempts",
            F.when(wrong, F.lit("response does not match its record type"))
            .otherwise(F.col("error")).alias("error"),
            F.when(wrong, F.lit("invalid")).otherwise(F.col("error_kind")).alias("error_kind"),
        )

    asked = df.select(*kept, prompt.alias("__prompt"))
    return stage_once(df.sparkSession, path, build, [asked, model, schema])


def drop_audit(df: DataFrame) -> DataFrame:
    return df.drop("attempts", "error", "error_kind")


def select_documents(
    docs: DataFrame,
    model: Model,
    path: str,
    template: str = SELECT_DOCUMENT,
    skip: str | None = None,
    **options,
) -> DataFrame:
    """Judge each document by its path; adds ``is_useful``.

    Every document is judged by the model.  Paths that match the pattern
    ``skip``, if given, cost no call: they are kept as not useful, with no attempt.
    """
    prompt = render_prompt(template, file_path="file_path", key="file_path")
    if skip is None:
        return ask(docs, "file_path", prompt, S.DOCUMENT_CHOICE, model, path, **options)
    out = F.coalesce(F.col("file_path").rlike(skip), F.lit(False))
    judged = ask(docs.where(~out), "file_path", prompt, S.DOCUMENT_CHOICE, model, path, **options)
    named = docs.where(out).withColumns({
        "is_useful": F.lit(False), "attempts": F.lit(0), "error": F.lit(None).cast("string"), "error_kind": F.lit(None).cast("string")})
    return judged.unionByName(named.select(*judged.columns))


def extract_topics(
    docs: DataFrame, model: Model, path: str, template: str = EXTRACT_TOPICS, **options
) -> DataFrame:
    """Topics of each document as an array; the text itself is not written again."""
    prompt = render_prompt(template, file_path="file_path", text="text", key="file_path")
    keep = [c for c in docs.columns if c != "text"]
    return ask(docs, "file_path", prompt, S.TOPIC_LIST, model, path, keep=keep, **options)


def topic_rows(extracted: DataFrame) -> DataFrame:
    """One row per topic with its position and a key of path and position."""
    rows = explode_with_parent(drop_audit(extracted), "topics", "topic_pos", "topic")
    kept = [c for c in rows.columns if c not in ("topic", "topic_pos")]
    return rows.select(
        *kept,
        "topic_pos",
        F.concat_ws(":", "file_path", F.col("topic_pos").cast("string")).alias("topic_key"),
        F.col("topic.title").alias("title"),
        F.col("topic.description").alias("description"),
    )


def judge_topics(
    topics: DataFrame, model: Model, path: str, template: str = JUDGE_TOPIC, **options
) -> DataFrame:
    """Adds ``is_useful`` and ``reason`` to each topic."""
    prompt = render_prompt(template, title="title", description="description", key="topic_key")
    return ask(topics, "topic_key", prompt, S.USEFULNESS, model, path, **options)


def dispatch_problem_type(
    topics: DataFrame,
    model: Model | None = None,
    path: str | None = None,
    template: str = CHOOSE_PROBLEM_TYPE,
    **options,
) -> DataFrame:
    """Adds ``problem_type``; without a model every topic is ``qa``.

    An answer outside the known kinds stops the job.
    """
    if model is None or path is None:
        return topics.withColumn("problem_type", F.lit("qa"))
    prompt = render_prompt(template, title="title", description="description", key="topic_key")
    asked = ask(topics, "topic_key", prompt, S.PROBLEM_TYPE, model, path, **options)
    known = F.col("problem_type").isNull() | F.col("problem_type").isin(*S.PROBLEM_KINDS)
    unknown = F.concat(F.lit("unknown problem type: "), F.col("problem_type"))
    return fail_unless(asked, known, unknown)


def generate_qa(
    topics: DataFrame,
    model: Model,
    path: str,
    max_items: int | None = None,
    template: str = WRITE_QUESTIONS,
    **options,
) -> DataFrame:
    """Question and answer pairs of each topic as the array ``tasks``.

    ``max_items=1`` is the single-question form, which uses the first pair only.
    """
    prompt = render_prompt(
        template, file_path="file_path", title="title", description="description", key="topic_key"
    )
    asked = ask(topics, "topic_key", prompt, S.QA_LIST, model, path, **options)
    if max_items is None:
        return asked
    return asked.withColumn("tasks", F.slice("tasks", 1, max_items))


def qa_rows(generated: DataFrame) -> DataFrame:
    """One row per pair with its position and key; a topic without pairs gives none."""
    rows = explode_with_parent(drop_audit(generated), "tasks", "qa_pos", "task")
    kept = [c for c in rows.columns if c not in ("task", "qa_pos")]
    return rows.select(
        *kept,
        "qa_pos",
        F.concat_ws(":", "topic_key", F.col("qa_pos").cast("string")).alias("qa_key"),
        F.col("task.question").alias("question"),
        F.col("task.answer").alias("answer"),
    )


def hindsight_reasoning(
    pairs: DataFrame, model: Model, path: str, template: str = EXPLAIN_ANSWER, **options
) -> DataFrame:
    """Adds ``reasoning``; null means that the pair is to be dropped."""
    prompt = render_prompt(
        template, file_path="file_path", question="question", answer="answer", key="qa_key"
    )
    return ask(pairs, "qa_key", prompt, S.REASONING, model, path, **options)


def answer_questions(
    records: DataFrame, model: Model, path: str, template: str = SOLVE_QUESTION, **options
) -> DataFrame:
    """Adds ``agent_answer`` (last message) and ``agent_reasoning`` (first reasoning or empty)."""
    prompt = render_prompt(template, question="question", key="qa_key")
    asked = ask(records, "qa_key", prompt, S.ANSWER_ITEMS, model, path, **options)
    return asked.withColumns({
        "agent_answer": last_content("items", "message"),
        "agent_reasoning": first_content("items", "reasoning"),
    }).drop("items")


def judge_answers(
    answered: DataFrame, model: Model, path: str, template: str = JUDGE_ANSWER, **options
) -> DataFrame:
    """Adds ``is_correct`` and ``reason`` by comparison with the known answer."""
    prompt = render_prompt(
        template, question="question", answer="answer", agent_answer="agent_answer", key="qa_key"
    )
    return ask(answered, "qa_key", prompt, S.ANSWER_VERDICT, model, path, **options)


def verify_records(
    records: DataFrame, model: Model, path: str, template: str = VERIFY_RECORD, **options
) -> DataFrame:
    """Adds ``is_valid`` and ``feedback`` on the reasoning of each record."""
    prompt = render_prompt(
        template, question="question", reasoning="reasoning", answer="answer", key="qa_key"
    )
    return ask(records, "qa_key", prompt, S.QRA_VERDICT, model, path, **options)
