"""Declared schemas.  ``nullable=False`` marks a field a record must have."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()


def required(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable=False) for n, t in fields.items()])


def optional(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable=True) for n, t in fields.items()])


# Package-registry dump.
CRATES = optional(
    id=_L, name=_S, created_at=_S, repository=_S, description=_S,
    documentation=_S, homepage=_S, readme=_S,
)
CRATE_DOWNLOADS = optional(crate_id=_L, downloads=_L)
DEPENDENCIES = optional(version_id=_L, crate_id=_L)
VERSIONS = optional(id=_L, crate_id=_L)

# Records.
DOCUMENT = required(file_path=_S, text=_S)
TOPIC = required(title=_S, description=_S)
TOPIC_ENTITY = required(file_path=_S, topic=TOPIC)
QA = required(question=_S, answer=_S)
QRA = required(question=_S, answer=_S, reasoning=_S)
VERIFIABLE_PROBLEM = required(
    task_name=_S, problem_statement=_S, canonical_solution=_S, test_code=_S
)
SOLVE_RESULT = required(qra=QRA, agent_reasoning=_S, agent_answer=_S, is_correct=_B)
EXAM_ROW = optional(
    id=_S, topic_title=_S, topic_description=_S, file_path=_S, question=_S,
    solution_commit=_S, problem_commit=_S, image_name=_S, status=_S,
)
EXAM_OUTCOME = optional(
    topic_key=_S, question=_S, exit_code=T.IntegerType(), solution_commit=_S, problem_commit=_S, error=_S,
)
REPOSITORY = required(name=_S, local_dir=_S)
CODING_EXAM = required(
    id=_S, image_name=_S, project=REPOSITORY, library=REPOSITORY,
    solution_commit=_S, problem_commit=_S, question=_S,
)
TEST_RESULT = required(is_success=_B, stdout=_S, stderr=_S)
MESSAGE = required(role=_S, content=_S)

# Typed model responses.
DOCUMENT_CHOICE = required(is_useful=_B)
TOPIC_LIST = required(topics=T.ArrayType(TOPIC, containsNull=False))
USEFULNESS = required(is_useful=_B, reason=_S)
PROBLEM_TYPE = required(problem_type=_S)
QA_LIST = required(tasks=T.ArrayType(QA, containsNull=False))
REASONING = T.StructType([T.StructField("reasoning", _S, nullable=True)])
ANSWER_ITEM = required(kind=_S, content=_S)
ANSWER_ITEMS = required(items=T.ArrayType(ANSWER_ITEM, containsNull=False))
ANSWER_VERDICT = required(reason=_S, is_correct=_B)
QRA_VERDICT = required(is_valid=_B, feedback=_S)

# The problem kinds a topic may be dispatched to.
PROBLEM_KINDS = ("programming", "qa")
