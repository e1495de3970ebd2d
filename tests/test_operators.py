import pytest
from pyspark.sql import functions as F

from lectern.operators import conversations, exams, metrics, records, relational as R, rollouts
from lectern.operators.positions import with_position


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_anti_join_with_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    right = spark.createDataFrame([(1,), (None,), (1,)], "k int")
    assert rows(R.without_listed(left, "id", right, "k")) == [(2,)]


def test_distinct_count_with_null(spark):
    df = spark.createDataFrame([("g", 1), ("g", 2), ("g", None), ("g", 2)], "k string, v int")
    assert rows(R.distinct_count(df, "k", "v", "n")) == [("g", 3)]
    assert rows(R.distinct_count(df, "k", "v", "n", count_null=False)) == [("g", 2)]
    assert rows(R.distinct_count(df, "k", "v", "n", approximate_error=0.05)) == [("g", 3)]


def test_equality_does_not_match_nulls(spark):
    df = spark.createDataFrame([("a", "a"), (None, None), ("a", None)],
                               "target_repo string, dependant_repo string")
    assert R.same_repository(df).count() == 1


def test_conditions_drop_null(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, 1)], "a int, b int")
    assert R.where_all(df, F.col("a") > 0, F.col("b") > 0).count() == 1


def test_lookup(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 0)], "id string, n int")
    assert rows(R.lookup_by_id(df, "a", order_by=["n"])) == [("a", 1)]
    with pytest.raises(ValueError, match="no row"):
        R.lookup_by_id(df, "c")


def test_top_k_settles_ties(spark):
    df = spark.createDataFrame([(i, 1) for i in range(9, 0, -1)], "id int, n int")
    assert [r.id for r in R.top_k(df, "n", 3, "id").collect()] == [1, 2, 3]
    assert "TakeOrderedAndProject" in plan_of(R.top_k(df, "n", 3, "id"))


def test_sort_is_by_code_point(spark):
    df = spark.createDataFrame([("b",), ("B",), ("é",), ("😀",), ("a",)], "q string")
    assert [r.q for r in R.sorted_head(df, 5, "q").collect()] == sorted("bBé😀a")
    assert R.sorted_head(df, None, "q").count() == 5


def test_sample_one(spark):
    df = spark.createDataFrame([(str(i),) for i in range(20)], "id string")
    picks = {R.sample_one(df, "id", seed).first().id for seed in range(8)}
    assert len(picks) > 3
    assert R.sample_one(df, "id", 1).collect() == R.sample_one(df, "id", 1).collect()
    assert R.sample_one(df.limit(0), "id", 1).count() == 0


def test_explode_leaves_out_empty_lists(spark):
    df = spark.createDataFrame([("a", [1, 2]), ("b", []), ("c", None)], "f string, xs array<int>")
    assert rows(R.explode_with_parent(df, "xs", "pos", "x")) == [("a", 0, 1), ("a", 1, 2)]


def test_union_by_name(spark):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    other = spark.createDataFrame([("y", 2)], "b string, a int")
    assert rows(R.union_results(None, one, other)) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        R.union_results(None)


@pytest.mark.parametrize("parts", [1, 7])
def test_positions(spark, folder, parts):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("k")).repartition(parts)
    got = with_position(df, ["k"], folder)
    assert got.where("pos = k").count() == 1000
    assert got.columns == ["k", "pos"]


def test_accuracy(spark):
    schema = "is_correct boolean"
    empty = metrics.accuracy_summary(spark.createDataFrame([], schema)).first()
    assert tuple(empty) == (0, 0, 0.0)
    some = metrics.accuracy_summary(spark.createDataFrame([(True,), (True,), (False,)], schema)).first()
    assert (some.total, some.correct) == (3, 2) and abs(some.accuracy - 200 / 3) < 1e-9
    shown = spark.createDataFrame([(0.125,), (66.666,), (100.0,)], "a double")
    assert [r[0] for r in shown.select(metrics.accuracy_text(F.col("a"))).collect()] == [
        f"{x:.2f}%" for x in (0.125, 66.666, 100.0)]


def test_rows_counted_during_a_write(spark, folder):
    df, seen = metrics.counted(spark.range(7), "stage")
    df.write.parquet(folder)
    assert seen.get == {"rows": 7}


def test_funnel(spark):
    got = metrics.stage_funnel(first=spark.range(3), second=spark.range(0))
    assert rows(got) == [(0, "first", 3), (1, "second", 0)]


EVENTS = [("c", 0, "hello"), ("c", 1, "[no text content]"), ("c", 2, "hi"),
          ("c", 3, "a [no text content] b"), ("c", 4, "[no text content]"), ("c", 5, None),
          ("d", 0, "fine")]


@pytest.mark.parametrize("limit,turn,left", [(0, 1, 2), (1, 3, 4), (2, 4, 5), (3, None, 6)])
def test_stuck_conversations(spark, limit, turn, left):
    events = spark.createDataFrame(EVENTS, "conv_id string, turn int, text string")
    stuck = conversations.stuck_conversations(events, limit)
    assert rows(stuck) == ([] if turn is None else [("c", turn)])
    kept = conversations.until_stuck(events, limit)
    assert kept.where("conv_id = 'c'").count() == left and kept.where("conv_id = 'd'").count() == 1


def test_stuck_conversations_limit_rows_before_the_shuffle(spark):
    events = spark.createDataFrame(EVENTS, "conv_id string, turn int, text string")
    plan = plan_of(conversations.stuck_conversations(events))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")
    assert "Partial" in plan and "Final" in plan


def exam_candidates(spark):
    schema = ("topic_key string, topic_title string, topic_description string, file_path string, "
              "question string, exit_code int, solution_commit string, problem_commit string, error string")
    return spark.createDataFrame([
        ("ok", "t", "d", "f", "q", 0, "s", "p", None),
        ("red", "t", "d", "f", "q", 101, None, None, None),
        ("nosol", "t", "d", "f", "q", 0, None, "p", None),
        ("noprob", "t", "d", "f", "q", 0, "s", None, None),
        ("unknown", "t", "d", "f", "q", None, "s", "p", None),
        ("boom", "t", "d", "f", "q", None, None, None, "agent stuck"),
        ("noq", "t", "d", "f", None, 0, "s", "p", None),
    ], schema)


def test_exam_gate_and_rows(spark):
    candidates = exam_candidates(spark)
    reasons = dict(exams.exam_gate(candidates).select("topic_key", "reject_reason").collect())
    assert reasons == {
        "ok": None, "noq": None, "red": "tests failed", "unknown": "tests failed",
        "boom": "tests failed", "nosol": "no solution commit", "noprob": "no problem commit",
    }
    made = {r.topic_key: r for r in exams.exam_rows(candidates, F.lit("img")).collect()}
    assert set(made) == {"ok", "boom", "noq"}
    assert made["boom"].status == "failed: agent stuck" and made["boom"].question == ""
    assert made["boom"].topic_title == "t" and not made["boom"].id.startswith("exam-")
    assert made["ok"].status == "generated" and made["ok"].id.startswith("exam-")
    assert made["noq"].question == ""


def test_exam_loading(spark):
    table = exams.exam_rows(exam_candidates(spark), F.lit("")).drop("topic_key")
    loaded = exams.load_exams(table, "base", "/srv/practice/", "/srv/lib")
    assert loaded.count() == 2
    first = loaded.first()
    assert (first.image_name, first.project.name, first.library.local_dir) == (
        "base", "practice", "/srv/lib")
    assert exams.load_exams(table, "base", "/p", "/l", include_failed=True).count() == 3
    assert exams.load_exams(table.drop("image_name"), "base", "/p", "/l").first().image_name == "base"
    one = exams.load_exam(table, first.id, "base", "/p", "/l", project_name="given").first()
    assert (one.image_name, one.project.name) == ("", "given")
    assert exams.load_exam(
        table.drop("image_name"), first.id, "base", "/p", "/l").first().image_name == "base"
    with pytest.raises(ValueError):
        exams.load_exam(table, "none", "base", "/p", "/l")


def test_solve_rate(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, False)],
                               "with_library boolean, success boolean")
    assert rows(exams.solve_rate(df)) == [(False, 1, 0, 0.0), (True, 2, 1, 0.5)]


def test_rollouts(spark):
    tasks = spark.createDataFrame([("a",), ("b",)], "id string")
    outcomes = spark.createDataFrame(
        [("a", i, i % 2 == 0) for i in range(1, 5)] + [("b", i, True) for i in range(1, 5)]
        + [("a", 5, True), ("z", 1, True)], "id string, attempt int, success boolean")
    rewards = rollouts.rollout_rewards(tasks, outcomes, "id", outside="drop")
    assert rewards.count() == 8
    scored = {(r.id, r.attempt): r.advantage for r in rollouts.group_advantage(rewards, "id").collect()}
    assert all(scored["b", i] == 0 for i in range(1, 5))
    assert abs(scored["a", 2] - 0.8660254) < 1e-6 and abs(scored["a", 1] + 0.8660254) < 1e-6
    single = rewards.where("attempt = 1")
    assert {r.advantage for r in rollouts.group_advantage(single, "id").collect()} == {0.0}


def test_advantage_is_not_a_window(spark):
    rewards = spark.createDataFrame([("a", 1.0)], "id string, reward double")
    assert "Window" not in plan_of(rollouts.group_advantage(rewards, "id"))


def test_length_budget(spark):
    df = spark.createDataFrame([("a", " one two  three "), ("b", "one"), ("c", ""), ("d", None)],
                               "k string, t string")
    assert [r[0] for r in df.select(rollouts.word_count(F.col("t"))).collect()] == [3, 1, 0, None]
    kept = rollouts.length_budget(df, "t", 2, "k", "drop")
    assert [r.k for r in kept.collect()] == ["b", "c", "d"]
    cut = rollouts.length_budget(df, "t", 2, "k", "truncate")
    assert [r.t for r in cut.collect()] == [" one two", "one", "", None]
    assert [r.t for r in rollouts.length_budget(df, "t", 0, "k", "truncate").collect()][:2] == ["", ""]
    with pytest.raises(Exception, match="t too long for k a: 3 > 2"):
        rollouts.length_budget(df, "t", 2, "k").count()
    assert rollouts.length_budget(df, "t", 3, "k").count() == 4
    with pytest.raises(ValueError):
        rollouts.length_budget(df, "t", 3, "k", "shrink")


def test_records(spark):
    topics = spark.createDataFrame([("f", 0, "t", "d")],
                                   "file_path string, topic_pos int, title string, description string")
    entity = records.topic_entities(topics).first()
    assert (entity.file_path, entity.topic.title) == ("f", "t")
    judged = spark.createDataFrame(
        [("k", "q", "a", "r", "ar", "aa", True)],
        "qa_key string, question string, answer string, reasoning string, "
        "agent_reasoning string, agent_answer string, is_correct boolean")
    assert records.solve_results(judged).first().qra.reasoning == "r"


def test_long_texts_are_cut_by_words(spark):
    df = spark.createDataFrame([(1, " ".join(["w  x\n"] * 15_000)), (2, None), (3, "a b")], "k int, t string")
    cut = {r.k: r.t for r in rollouts.length_budget(df, "t", 20_000, "k", "truncate").collect()}
    assert len(cut[1].split()) == 20_000 and cut[1].startswith("w  x\n w") and cut[2] is None and cut[3] == "a b"


def test_outcomes_outside_the_attempts(spark):
    tasks = spark.createDataFrame([("a",)], "id string")
    outcomes = spark.createDataFrame([("a", i, True) for i in range(8)], "id string, attempt int, success boolean")
    with pytest.raises(Exception, match="outside 1..4"):
        rollouts.rollout_rewards(tasks, outcomes, "id").collect()
    assert rollouts.rollout_rewards(tasks, outcomes, "id", outside="drop").count() == 4
    assert rollouts.rollout_rewards(tasks, outcomes, "id", outside="keep").count() == 8
