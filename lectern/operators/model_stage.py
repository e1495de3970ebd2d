"""The generic model stage: a prompt per row in, a response per row out.

The prompt is the only column that goes to Python; all others stay in the JVM
and need no join to be found again.  A stage is a job with outside effects, so
callers write its result with ``stage_once`` and go on from the written table.
"""

import uuid
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.scalars import generation_status
from lectern.functions.structured import fail_unless
from lectern.operators.relational import join_per_key
from lectern.session import fresh_path, hadoop_path, path_exists
from lectern.sources.identity import digest

RESPONSE_COLUMNS = ("response", "attempts", "error", "error_kind")
_RESULT = "response string, attempts int, error string, error_kind string"
#: Broken groups up to this many are broadcast, so that the other rows need no shuffle.
BROADCAST_GROUPS = 100_000
#: Bytes of written prompts that a task gets at a time where ``concurrency`` bounds the tasks.
WAVE_BYTES = 64_000_000
#: Rows of a written file of prompts; a wave has at least one file.
WAVE_ROWS = 100_000
#: Characters of answers that a task hands on at a time.
PIECE_CHARS = 2_000_000
_STORED = f"prompt_hash string, {_RESULT}, asked_by string"


class ModelCallError(Exception):
    """A failed model call that is worth another attempt."""


@dataclass(frozen=True)
class CallableModel:
    """A model made in the Python worker by ``load``, once per task.

    The loaded object takes a list of prompts and returns a list as long, of
    response texts (``None`` for no answer) or exceptions for single failures.
    An exception it raises fails that attempt of every prompt in the call; the
    next attempt sends each of them on its own, so that one bad prompt does not
    fail the others again.  No prompt is ever sent more than ``max_attempts``
    times.  ``batch_size`` prompts go into one
    call and ``threads`` calls run at a time in each task.

    ``name`` tells models apart whose code does not: the model and version that
    a server answers with.  Results and answers are kept under it; without one,
    under the code of ``load`` and all it refers to.
    """

    load: Callable[[], Callable[[list[str]], list]]
    retry_on: tuple = (ModelCallError,)
    max_attempts: int = 1
    batch_size: int = 64
    threads: int = 1
    name: str | None = None

    @property
    def identity(self) -> str:
        """What answers of this model are kept under."""
        return digest("name", self.name) if self.name else digest("code", self.load)

    def __made_from__(self) -> list:
        # How prompts are dealt to calls does not change an answer.
        return [self.identity, self.retry_on, self.max_attempts]


@dataclass(frozen=True)
class RecordedModel:
    """Answers known before: a table of ``prompt_hash`` (sha-256 hex) and ``response``.

    Of several answers to one prompt the first in text order is taken.
    """

    responses: DataFrame

    def __made_from__(self) -> list:
        return [self.responses]


@dataclass(frozen=True)
class AnswerStore:
    """A table of answers by model and prompt, kept from run to run.

    ``path`` holds rows (prompt_hash, response, attempts, error, error_kind,
    asked_by) in folders by model identity.  Only prompts without an answer are
    sent, each once however many rows have it.  A task's answers are there as
    soon as the task is done, whatever becomes of the job: ``prompts_per_task``
    is what a stopped job may have to send again per running task.  Failures are
    noted for the run that met them and asked again by the next.
    """

    path: str
    prompts_per_task: int = 1000

    def folder(self, model: CallableModel) -> str:
        return f"{self.path}/model={model.identity}"

    def answers(self, spark: SparkSession, model: CallableModel, run: str | None = None) -> DataFrame:
        """One row per prompt hash: its answer, or what ``run`` failed with."""
        folder = self.folder(model)
        if not path_exists(spark, folder):
            return spark.createDataFrame([], _STORED)
        rows = spark.read.schema(_STORED).parquet(folder)
        usable = rows.where(F.col("error").isNull() | F.col("asked_by").eqNullSafe(F.lit(run)))
        # An answer goes before a failure, then text order decides between two runs.
        order = F.struct(F.col("error").isNotNull().alias("failed"), F.col("response").isNull().alias("none"),
                         "response", "attempts", "error", "error_kind")
        best = usable.groupBy("prompt_hash").agg(F.min(order).alias("best"))
        return best.select("prompt_hash", *[F.col(f"best.{c}").alias(c) for c in RESPONSE_COLUMNS])


def _send(infer, prompts: list[str]) -> list:
    try:
        replies = list(infer(prompts))
    except Exception as failure:
        return [failure] * len(prompts)
    if len(replies) != len(prompts):
        raise RuntimeError(f"the model gave {len(replies)} replies to {len(prompts)} prompts")
    return replies


def _answer(infer, prompts: list[str], max_attempts: int, retry_on: tuple) -> pd.DataFrame:
    """Ask until each prompt has a reply, a final failure or no attempt left."""
    rows: list = [None] * len(prompts)
    waiting = list(range(len(prompts)))
    alone = False
    for attempt in range(1, max_attempts + 1):
        again = []
        calls = [[i] for i in waiting] if alone else [waiting]
        replies = [reply for call in calls for reply in _send(infer, [prompts[i] for i in call])]
        # The failure of a whole call says nothing yet about its prompts.
        shared = len(waiting) > 1 and not alone and all(r is replies[0] for r in replies) and isinstance(replies[0], Exception)
        for i, reply in zip(waiting, replies):
            if shared and attempt < max_attempts:
                again.append(i)
            elif not isinstance(reply, Exception):
                rows[i] = (reply, attempt, None, None)
            elif not isinstance(reply, retry_on):
                rows[i] = (None, attempt, f"{type(reply).__name__}: {reply}", "other")
            elif attempt == max_attempts:
                rows[i] = (None, attempt, f"{type(reply).__name__}: {reply}", "exhausted")
            else:
                again.append(i)
        alone, waiting = shared, again
        if not waiting:
            break
    return pd.DataFrame(rows, columns=list(RESPONSE_COLUMNS))


def _in_order(pool: ThreadPoolExecutor, ask: Callable, prompts: pd.Series, size: int, ahead: int) -> Iterator[pd.DataFrame]:
    """Answers to ``size`` prompts at a time, with no more than ``ahead`` calls given to the pool."""
    waiting: deque = deque()
    for start in range(0, len(prompts), size):
        waiting.append(pool.submit(ask, prompts.iloc[start:start + size].tolist()))
        if len(waiting) >= ahead:
            yield waiting.popleft().result()
    while waiting:
        yield waiting.popleft().result()


def _pieces(answered: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The answers in tables of about ``PIECE_CHARS``, so that those to a whole batch are never held."""
    held, chars = [], 0
    for part in answered:
        held.append(part)
        chars += sum(len(response) for response in part["response"] if isinstance(response, str))
        if chars >= PIECE_CHARS:
            yield pd.concat(held, ignore_index=True)
            held, chars = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _caller(model: CallableModel):
    load, retry_on, max_attempts = model.load, tuple(model.retry_on), model.max_attempts
    batch_size, threads = model.batch_size, model.threads

    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        infer = load()

        def ask(texts: list[str]) -> pd.DataFrame:
            return _answer(infer, texts, max_attempts, retry_on)

        with ThreadPoolExecutor(max_workers=threads) as pool:
            for prompts in batches:
                yield from _pieces(_in_order(pool, ask, prompts, batch_size, 2 * threads))

    return F.pandas_udf(call, returnType=_RESULT).asNondeterministic()


def run_model(
    df: DataFrame,
    key: str,
    prompt: Column,
    model: CallableModel | RecordedModel,
    concurrency: int | None = None,
    store: AnswerStore | None = None,
    spread: bool = True,
    placed: str | None = None,
) -> DataFrame:
    """Add ``response``, ``attempts``, ``error`` and ``error_kind`` to each row.

    ``error_kind`` is ``exhausted`` (a retryable failure on every attempt),
    ``other`` (any other failure, not tried again) or ``missing`` (no recorded
    answer).  Rows are spread by ``key`` so that calls run on all task slots
    however the input files are cut; without ``spread`` they are called where they
    lie, which is for the written table of a step that has spread them.
    ``concurrency`` sets the number of partitions: no more than that many tasks,
    each with the model's ``threads``, have a call in flight.  The rows are written
    first, and more than ``WAVE_BYTES`` for each of these tasks are called at once,
    wave after wave, so that a task's share does not grow with the table.
    ``placed`` names a column for the number of the task that made the call.  With a ``store`` the calls are made at once, for the
    prompts that have no answer in it, and the rows get their answers from it.
    """
    if isinstance(model, RecordedModel):
        hashed = df.withColumn("prompt_hash", F.sha2(prompt, 256))
        answers = model.responses.groupBy("prompt_hash").agg(
            F.min("response").alias("response"), F.lit(True).alias("__known")
        )
        joined = join_per_key(hashed, answers, "prompt_hash", "left")
        missing = F.col("__known").isNull()
        return joined.select(
            *df.columns,
            "response",
            F.when(missing, F.lit(0)).otherwise(F.lit(1)).alias("attempts"),
            F.when(missing, F.lit("no recorded response")).alias("error"),
            F.when(missing, F.lit("missing")).alias("error_kind"),
        )
    if store is not None:
        return _stored_answers(df, prompt, model, concurrency, store)
    more = [] if placed is None else [F.spark_partition_id().alias(placed)]

    def called(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__call", _caller(model)(prompt)).select(
            *df.columns, *[F.col(f"__call.{c}").alias(c) for c in RESPONSE_COLUMNS], *more)

    if concurrency is None:
        return called(df.repartition(key) if spread else df)
    waves, discard = _waves(df, key, concurrency)
    if len(waves) == 1:
        return called(waves[0])
    path = fresh_path(df.sparkSession, "answered")
    for wave in waves:
        called(wave).write.mode("append").option("compression", "zstd").parquet(path)
    discard()
    return df.sparkSession.read.schema(called(df).schema).parquet(path)


def _waves(df: DataFrame, key: str, concurrency: int) -> tuple[list[DataFrame], Callable[[], None]]:
    """The rows, written, in parts of ``concurrency`` partitions, and what deletes the written rows.

    A part has about ``WAVE_BYTES`` a partition, or a single file.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, "asked")
    df.write.option("compression", "zstd").option("maxRecordsPerFile", WAVE_ROWS).parquet(path)
    fs, target = hadoop_path(spark, path)
    parts, size = [[]], 0
    for status in fs.listStatus(target):
        if not status.getPath().getName().endswith(".parquet"):
            continue
        if parts[-1] and size + status.getLen() > WAVE_BYTES * concurrency:
            parts.append([])
            size = 0
        parts[-1].append(status.getPath().toString())
        size += status.getLen()
    read = spark.read.schema(df.schema)
    waves = [read.parquet(*(files if len(parts) > 1 else [path])).repartition(concurrency, key) for files in parts]
    return waves, lambda: fs.delete(target, True)


def _stored_answers(
    df: DataFrame, prompt: Column, model: CallableModel, concurrency: int | None, store: AnswerStore
) -> DataFrame:
    """Ask what the store cannot answer, then answer every row from it."""
    spark = df.sparkSession
    hashed = df.withColumn("__prompt_hash", F.sha2(prompt, 256))
    known = store.answers(spark, model).select(F.col("prompt_hash").alias("__prompt_hash"))
    wanted = df.select(F.sha2(prompt, 256).alias("__prompt_hash"), prompt.alias("__prompt")).where("__prompt is not null")
    fresh = wanted.join(known, "__prompt_hash", "left_anti").groupBy("__prompt_hash").agg(F.first("__prompt").alias("__prompt"))
    run = uuid.uuid4().hex
    if concurrency is None:
        tasks = max(1, -(-fresh.count() // store.prompts_per_task))
        waves, discard = [fresh.repartition(tasks, "__prompt_hash")], None
    else:
        waves, discard = _waves(fresh, "__prompt_hash", concurrency)
    for wave in waves:
        asked = wave.withColumn("__call", _caller(model)(F.col("__prompt"))).select(
            F.col("__prompt_hash").alias("prompt_hash"), *[F.col(f"__call.{c}").alias(c) for c in RESPONSE_COLUMNS],
            F.lit(run).alias("asked_by"))
        # Files of a finished task go to the table at once, not with the end of the job.
        asked.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(store.folder(model))
    if discard is not None:
        discard()
    answers = store.answers(spark, model, run).withColumnRenamed("prompt_hash", "__prompt_hash")
    return join_per_key(hashed, answers, "__prompt_hash", "left").select(*df.columns, *RESPONSE_COLUMNS)


def apply_error_policy(df: DataFrame, policy: str, group: str | None = None) -> DataFrame:
    """What becomes of rows with an error.

    ``drop_row`` drops the row; ``drop_group`` drops every row of a group in
    which a row failed for a reason other than exhausted attempts, and the
    failed rows of the remaining groups; ``status_row`` keeps all rows and adds
    ``status``; ``fail`` stops the job.  ``df`` should be a written table: the
    broken groups are counted first, and only very many of them cost a shuffle.
    """
    good = F.col("error").isNull()
    if policy == "drop_row":
        return df.where(good)
    if policy == "drop_group":
        if group is None:
            raise ValueError("drop_group needs the group column")
        broken = df.where(F.col("error_kind") == "other").select(group).distinct()
        if broken.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
            return df.where(good).join(F.broadcast(broken), group, "left_anti")
        return join_per_key(df.where(good), broken, group, "left_anti")
    if policy == "status_row":
        return df.withColumn("status", generation_status("error"))
    if policy == "fail":
        return fail_unless(df, good, F.concat(F.lit("model stage failed: "), F.col("error")))
    raise ValueError(f"unknown error policy {policy!r}")
