import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lectern import schemas as S
from lectern.operators import curation, model_stage
from lectern.operators.model_stage import (
    AnswerStore,
    CallableModel,
    ModelCallError,
    RecordedModel,
    apply_error_policy,
    run_model,
)
from lectern.sources.stages import stage_once

# The models below go to the Python workers with the functions that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Flaky:
    """Prompt ``n:kind`` succeeds at attempt n, or fails for good as ``kind`` says."""

    def __init__(self):
        self.seen = {}

    def __call__(self, prompts):
        return [self.one(p) for p in prompts]

    def one(self, prompt):
        need, kind = prompt.split(":")
        self.seen[prompt] = self.seen.get(prompt, 0) + 1
        if kind == "bad":
            return ValueError("bad record")
        if kind == "none":
            return None
        if self.seen[prompt] < int(need):
            return ModelCallError("again")
        return f"done {prompt}"


class RaisesForBatch:
    """Raises for the whole call if one of its prompts is bad."""

    def __call__(self, prompts):
        if any(p.startswith("bad") for p in prompts):
            raise ValueError("one of the prompts is bad")
        return [p.upper() for p in prompts]


class WrongLength:
    def __call__(self, prompts):
        return ["x"] * (len(prompts) + 1)


def asked(spark, prompts, model, **options):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prompts)], "k int, p string")
    out = run_model(df, "k", F.col("p"), model, **options)
    return {r.p: (r.response, r.attempts, r.error, r.error_kind) for r in out.collect()}


def test_retries_and_error_kinds(spark):
    got = asked(spark, ["1:ok", "2:ok", "3:ok", "4:ok", "1:bad", "1:none"],
                CallableModel(Flaky, max_attempts=3))
    assert got == {
        "1:ok": ("done 1:ok", 1, None, None),
        "2:ok": ("done 2:ok", 2, None, None),
        "3:ok": ("done 3:ok", 3, None, None),
        "4:ok": (None, 3, "ModelCallError: again", "exhausted"),
        "1:bad": (None, 1, "ValueError: bad record", "other"),
        "1:none": (None, 1, None, None),
    }


def test_other_errors_can_be_retried_too(spark):
    got = asked(spark, ["1:bad"], CallableModel(Flaky, retry_on=(ValueError,), max_attempts=2))
    assert got["1:bad"][1:] == (2, "ValueError: bad record", "exhausted")


def test_a_raised_error_is_put_on_its_own_prompt(spark):
    prompts = ["a", "b", "bad", "c"]
    got = asked(spark, prompts, CallableModel(RaisesForBatch, max_attempts=2), concurrency=1)
    assert {p: r[0] for p, r in got.items()} == {"a": "A", "b": "B", "c": "C", "bad": None}
    assert got["bad"][3] == "other"


def test_a_model_that_loses_replies_stops_the_job(spark):
    with pytest.raises(Exception, match="2 replies to 1 prompts"):
        asked(spark, ["a"], CallableModel(WrongLength))


@pytest.mark.parametrize("concurrency,batch_size,threads", [(1, 3, 1), (5, 64, 1), (2, 4, 3), (None, 1, 2)])
def test_result_does_not_depend_on_partitions(spark, concurrency, batch_size, threads):
    prompts = [f"{i % 5 + 1}:{i}" for i in range(40)]
    model = CallableModel(Flaky, max_attempts=3, batch_size=batch_size, threads=threads)
    got = asked(spark, prompts, model, concurrency=concurrency)
    assert {p: r[1] for p, r in got.items()} == {p: min(int(p[0]), 3) for p in prompts}
    assert max(r[1] for r in got.values()) <= 3


def test_recorded_answers(spark):
    known = spark.createDataFrame([("a", "B"), ("a", "A"), ("b", None)], "p string, response string").select(
        F.sha2("p", 256).alias("prompt_hash"), "response")
    got = asked(spark, ["a", "b", "c"], RecordedModel(known))
    assert got == {"a": ("A", 1, None, None), "b": (None, 1, None, None),
                   "c": (None, 0, "no recorded response", "missing")}


def test_one_python_node_and_only_the_prompt_goes_there(spark):
    df = spark.createDataFrame([(1, "p", "wide")], "k int, p string, text string")
    plan = run_model(df, "k", F.col("p"), CallableModel(Flaky))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in text


def test_wrong_type_is_an_error(spark, folder):
    df = spark.createDataFrame([("k1", "a"), ("k2", "b")], "k string, p string")
    replies = spark.createDataFrame(
        [("a", '{"is_useful": true, "reason": "r"}'), ("b", '{"is_useful": "yes", "reason": "r"}')],
        "p string, response string").select(F.sha2("p", 256).alias("prompt_hash"), "response")
    got = curation.ask(df, "k", F.col("p"), S.USEFULNESS, RecordedModel(replies), folder)
    assert {r.k: (r.is_useful, r.error_kind) for r in got.collect()} == {
        "k1": (True, None), "k2": (None, "invalid")}


def failures(spark):
    return spark.createDataFrame(
        [("g1", 1, None, None), ("g1", 2, "x", "exhausted"), ("g2", 3, None, None),
         ("g2", 4, "y", "other"), ("g3", 5, None, None)],
        "g string, k int, error string, error_kind string")


def test_error_policies(spark):
    df = failures(spark)

    def keys(*args):
        return sorted(r.k for r in apply_error_policy(df, *args).collect())

    assert keys("drop_row") == [1, 3, 5]
    assert keys("drop_group", "g") == [1, 5]
    assert keys("status_row") == [1, 2, 3, 4, 5]
    statuses = {r.k: r.status for r in apply_error_policy(df, "status_row").collect()}
    assert statuses[1] == "generated" and statuses[4] == "failed: y"
    with pytest.raises(Exception, match="model stage failed"):
        apply_error_policy(df, "fail").count()
    assert apply_error_policy(df.where("error is null"), "fail").count() == 3
    with pytest.raises(ValueError):
        apply_error_policy(df, "drop_group")
    with pytest.raises(ValueError):
        apply_error_policy(df, "ignore")


class CountsCalls:
    """Leaves a mark for every call in a folder."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, prompts):
        import pathlib
        import uuid

        pathlib.Path(self.folder).mkdir(parents=True, exist_ok=True)
        for _ in prompts:
            (pathlib.Path(self.folder) / uuid.uuid4().hex).touch()
        return ["ok"] * len(prompts)


def test_a_written_stage_is_not_called_again(spark, folder, tmp_path):
    marks = str(tmp_path / "marks")
    df = spark.range(10).withColumn("p", F.col("id").cast("string"))
    model = CallableModel(lambda: CountsCalls(marks))
    staged = stage_once(spark, folder, lambda: run_model(df, "id", F.col("p"), model))
    assert staged.count() == staged.where("response = 'ok'").count() == 10
    assert len(list((tmp_path / "marks").iterdir())) == 10


def test_skipped_paths(spark, folder):
    docs = spark.createDataFrame(
        [("README.md",), ("CONTRIBUTING.md",), ("docs/changelog.rst",), ("a/Code_of_Conduct",),
         ("docs/changes-explained.md",)], "file_path string")

    class Yes:
        def __call__(self, prompts):
            return ['{"is_useful": true}'] * len(prompts)

    every = curation.select_documents(docs, CallableModel(Yes), f"{folder}/all")
    assert {r.file_path for r in every.where("is_useful").collect()} == {r.file_path for r in docs.collect()}
    pattern = r"(?i)(^|/)(contributing|code[_-]of[_-]conduct|changelog)(\.[a-z]+)?$"
    judged = curation.select_documents(docs, CallableModel(Yes), f"{folder}/some", skip=pattern)
    assert {r.file_path: (r.is_useful, r.attempts) for r in judged.collect()} == {
        "README.md": (True, 1), "docs/changes-explained.md": (True, 1), "CONTRIBUTING.md": (False, 0),
        "docs/changelog.rst": (False, 0), "a/Code_of_Conduct": (False, 0)}


def test_unknown_problem_type_stops_the_job(spark, folder):
    topics = spark.createDataFrame([("k", "t", "d")], "topic_key string, title string, description string")

    class Essay:
        def __call__(self, prompts):
            return ['{"problem_type": "essay"}'] * len(prompts)

    with pytest.raises(Exception, match="unknown problem type: essay"):
        curation.dispatch_problem_type(topics, CallableModel(Essay), folder).collect()
    assert curation.dispatch_problem_type(topics).first().problem_type == "qa"


class Counts:
    """Fails every call that holds a bad prompt, and notes what it is sent."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self):
        def infer(prompts):
            import os
            import uuid
            with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as file:
                file.write("\n".join(prompts))
            if "bad" in prompts:
                raise ModelCallError("bad")
            return [p.upper() for p in prompts]
        return infer


def test_no_prompt_is_sent_more_often_than_allowed(spark, tmp_path):
    prompts = ["a", "b", "bad", "c"]
    got = asked(spark, prompts, CallableModel(Counts(str(tmp_path)), max_attempts=3), concurrency=1)
    sent = [p for file in tmp_path.iterdir() for p in file.read_text().splitlines()]
    assert {p: sent.count(p) for p in prompts} == {"a": 2, "b": 2, "bad": 3, "c": 2}
    assert {p: r[1] for p, r in got.items()} == {"a": 2, "b": 2, "bad": 3, "c": 2}
    assert got["bad"][3] == "exhausted"


class Logs:
    """Upper-cases prompts and notes each; stops at a bad one while ``stop`` is there."""

    def __init__(self, folder, stop=None, suffix=""):
        self.folder, self.stop, self.suffix = folder, stop, suffix

    def __call__(self, prompts):
        import os
        import time
        import uuid
        out = []
        for p in prompts:
            if p == "bad" and self.stop and os.path.exists(self.stop):
                time.sleep(5)  # the other tasks finish first
                raise SystemExit("executor lost")
            with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as file:
                file.write(p)
            out.append(ModelCallError("busy") if p == "busy" and self.stop and os.path.exists(self.stop) else p.upper() + self.suffix)
        return out


def sent(folder):
    """The prompts sent since the last look."""
    found = sorted(f.read_text() for f in folder.iterdir())
    for f in folder.iterdir():
        f.rename(folder.parent / f"seen-{f.name}")
    return found


def store_of(spark, folder):
    return AnswerStore(f"{folder}/answers", prompts_per_task=1)


def table(spark, prompts):
    return spark.createDataFrame(list(enumerate(prompts)), "k int, p string")


def answers_of(df):
    return {(r.k, r.p): (r.response, r.attempts, r.error_kind) for r in df.collect()}


def test_a_stored_answer_is_not_asked_again(spark, folder, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    model, store = CallableModel(lambda: Logs(str(calls)), name="m-1"), store_of(spark, folder)
    first = run_model(table(spark, ["a", "b", "a", None]), "k", F.col("p"), model, store=store)
    assert answers_of(first) == {(0, "a"): ("A", 1, None), (1, "b"): ("B", 1, None), (2, "a"): ("A", 1, None), (3, None): (None, None, None)}
    assert sent(calls) == ["a", "b"]
    again = run_model(table(spark, ["b", "c"]), "k", F.col("p"), model, store=store)
    assert answers_of(again) == {(0, "b"): ("B", 1, None), (1, "c"): ("C", 1, None)}
    assert sent(calls) == ["c"]
    # Another model has its own answers; one of the same name has these.
    other = CallableModel(lambda: Logs(str(calls), suffix="!"), name="m-2")
    assert answers_of(run_model(table(spark, ["a"]), "k", F.col("p"), other, store=store)) == {(0, "a"): ("A!", 1, None)}
    assert sent(calls) == ["a"]
    moved = CallableModel(lambda: Logs(str(calls), suffix="?"), name="m-1")
    assert answers_of(run_model(table(spark, ["a"]), "k", F.col("p"), moved, store=store)) == {(0, "a"): ("A", 1, None)}
    assert sent(calls) == []


def test_a_failure_is_asked_again_by_the_next_run(spark, folder, tmp_path):
    calls, stop = tmp_path / "calls", tmp_path / "stop"
    calls.mkdir()
    stop.touch()
    model, store = CallableModel(lambda: Logs(str(calls), str(stop)), max_attempts=2, name="m"), store_of(spark, folder)
    df = table(spark, ["a", "busy"])
    assert answers_of(run_model(df, "k", F.col("p"), model, store=store)) == {(0, "a"): ("A", 1, None), (1, "busy"): (None, 2, "exhausted")}
    assert sent(calls) == ["a", "busy", "busy"]
    stop.unlink()
    assert answers_of(run_model(df, "k", F.col("p"), model, store=store)) == {(0, "a"): ("A", 1, None), (1, "busy"): ("BUSY", 1, None)}
    assert sent(calls) == ["busy"]


def test_a_stopped_run_keeps_the_answers_of_its_tasks(spark, folder, tmp_path):
    calls, stop = tmp_path / "calls", tmp_path / "stop"
    calls.mkdir()
    stop.touch()
    model, store = CallableModel(lambda: Logs(str(calls), str(stop)), name="m"), store_of(spark, folder)
    prompts = [f"p{i}" for i in range(12)] + ["bad"]
    with pytest.raises(Exception):
        run_model(table(spark, prompts), "k", F.col("p"), model, store=store)
    kept = {r.response for r in store.answers(spark, model).collect()}
    # Prompts that hash into one task with the bad one may be lost with it.
    assert len(kept) >= 6
    sent(calls)
    stop.unlink()
    got = run_model(table(spark, prompts), "k", F.col("p"), model, store=store)
    assert {r.response for r in got.collect()} == {p.upper() for p in prompts}
    assert {p.upper() for p in sent(calls)} == {p.upper() for p in prompts} - kept


def test_a_new_template_sends_only_its_own_prompts(spark, folder, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    class Useful(Logs):
        def __call__(self, prompts):
            super().__call__(prompts)
            return ['{"is_useful": true, "reason": "r"}'] * len(prompts)

    path = str(calls)
    model, store = CallableModel(lambda: Useful(path), name="m"), store_of(spark, folder)
    spark.createDataFrame([("k1", "t1", "d"), ("k2", "t2", "d")], "topic_key string, title string, description string").write.parquet(f"{folder}/topics")
    topics = spark.read.parquet(f"{folder}/topics")

    def judge(template):
        return curation.judge_topics(topics, model, f"{folder}/judged", template, store=store).count()

    assert judge("old {title} {description} {key}") == 2 and len(sent(calls)) == 2
    assert judge("old {title} {description} {key}") == 2 and sent(calls) == []
    # One prompt of the two reads the same under the new template.
    spark.createDataFrame([("k1", "old t1", "d"), ("k2", "t2", "d")], "topic_key string, title string, description string").write.mode("overwrite").parquet(f"{folder}/topics")
    topics = spark.read.parquet(f"{folder}/topics")
    assert judge("{title} {description} {key}") == 2 and sent(calls) == ["t2 d k2"]


def test_another_model_makes_a_stage_again(spark, folder):
    spark.createDataFrame([("k1", "t1", "d")], "topic_key string, title string, description string").write.parquet(f"{folder}/topics")
    topics = spark.read.parquet(f"{folder}/topics")

    def says(reason):
        return CallableModel(lambda: lambda prompts: [f'{{"is_useful": true, "reason": "{reason}"}}'] * len(prompts))

    for reason in ("one", "two"):
        assert curation.judge_topics(topics, says(reason), f"{folder}/judged").first().reason == reason


def test_answers_to_a_batch_are_handed_on_in_pieces(spark):
    """Of a whole Arrow batch only the calls under way and one piece of answers are held."""
    asked = []

    class Loud:
        def __call__(self, prompts):
            asked.extend(prompts)
            return [p + "x" * 100_000 for p in prompts]

    call = model_stage._caller(CallableModel(Loud, batch_size=5, threads=2)).func
    prompts = pd.Series([str(i) for i in range(200)])
    pieces, seen = call(iter([prompts])), []
    for piece in pieces:
        assert len(piece) <= 20
        seen += piece["response"].str.rstrip("x").tolist()
        assert len(asked) <= len(seen) + 20
    assert seen == prompts.tolist() and sorted(asked) == sorted(seen)


class Echo:
    def __call__(self, prompts):
        return list(prompts)


def test_rows_of_an_earlier_step_are_called_where_they_lie(spark, folder):
    spark.range(50).select(F.concat(F.lit("p"), F.col("id")).alias("k")).write.parquet(folder)
    rows = spark.read.parquet(folder)
    there = run_model(rows, "k", F.col("k"), CallableModel(Echo), spread=False)
    assert "Exchange" not in there._jdf.queryExecution().executedPlan().toString()
    spread = run_model(rows, "k", F.col("k"), CallableModel(Echo))
    assert sorted(there.collect()) == sorted(spread.collect())
    bound = run_model(rows, "k", F.col("k"), CallableModel(Echo), concurrency=2, spread=False)
    assert bound.rdd.getNumPartitions() == 2


def test_few_broken_groups_shuffle_no_other_row(spark, folder, monkeypatch):
    rows = [(f"g{i % 7}" if i % 11 else None, i, "boom" if i == 3 else None, "other" if i == 3 else None) for i in range(60)]
    spark.createDataFrame(rows, "g string, k long, error string, error_kind string").write.parquet(folder)
    written = spark.read.parquet(folder)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        few = apply_error_policy(written, "drop_group", "g")
        plan = few._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        monkeypatch.setattr(model_stage, "BROADCAST_GROUPS", 0)
        many = apply_error_policy(written, "drop_group", "g")
        assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()
        expected = [i for i in range(60) if i % 7 != 3 or not i % 11]
        assert [sorted(r.k for r in kept.collect()) for kept in (few, many)] == [expected, expected]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("stored", [False, True])
def test_bounded_tasks_take_a_large_table_in_waves(spark, folder, monkeypatch, stored):
    """Each wave has ``concurrency`` tasks, so what one of them reads does not grow with the table."""
    monkeypatch.setattr(model_stage, "WAVE_BYTES", 1)
    monkeypatch.setattr(model_stage, "WAVE_ROWS", 100)
    rows = spark.range(1000).select(F.concat(F.lit("p"), F.col("id")).alias("k"), F.lit(None).cast("string").alias("none")).coalesce(2)
    reads = []
    plain = model_stage._caller
    monkeypatch.setattr(model_stage, "_caller", lambda model: reads.append(1) or plain(model))
    options = {"store": AnswerStore(folder)} if stored else {"placed": "part"}
    got = run_model(rows, "k", F.col("k"), CallableModel(Echo), concurrency=3, **options).collect()
    assert sorted(r.k for r in got) == sorted(f"p{i}" for i in range(1000))
    assert all(r.response == r.k and r.none is None for r in got)
    assert len(reads) >= 10
    if not stored:
        assert {r.part for r in got} == {0, 1, 2}
