"""The command-line jobs, one after the other on the same folders."""

import json

from lectern import jobs
from lectern import schemas as S
from lectern.sources import csv_tables
from standins import models as M
from standins.views import view

from test_sources import text_file

def steps(spark):
    return M.STEPS


def test_rank_packages(spark, small, folder):
    for name in ("crates", "crate_downloads", "dependencies", "versions"):
        csv_tables.write_csv(view(spark, small, name), f"{folder}/dump/{name}.csv")
    best = jobs.main(["rank-packages", "--dump", f"{folder}/dump", "--work", f"{folder}/work",
                      "--cutoff", "1995-03-01T00:00:00Z", "--top", "5", "--out", f"{folder}/out"], spark)
    assert best.count() == 5
    written = spark.read.option("header", True).csv(f"{folder}/out")
    assert written.columns[:3] == ["name", "created_at", "direct_dependant_count"]


def test_documents_to_training_set(spark, folder):
    for i in range(6):
        text_file(spark, f"{folder}/docs/{i}.md", f"First part {i}. Second.\n\nOther line {i}.")
    text_file(spark, f"{folder}/docs/CHANGELOG.md", "Nothing to learn.")
    model = ["--model", "test_jobs:steps"]

    def run(name, *args):
        return jobs.main([name, *args, "--out", f"{folder}/{name}"], spark)

    made = run("synthesise", "--documents", f"{folder}/docs", "--work", f"{folder}/w1",
               "--batch-size", "5", *model)
    n = made.count()
    assert n > 0 and made.where("file_path like '%CHANGELOG%'").count() == 0
    lines = ["--records", f"{folder}/synthesise", "--layout", "lines"]

    summary = run("evaluate", *lines, "--work", f"{folder}/w2", "--limit", "5", *model).first()
    assert 0 < summary.total <= 5 and summary.accuracy.endswith("%")
    saved = spark.read.json(f"{folder}/evaluate")
    assert saved.count() == summary.total and "qra" in saved.columns

    statuses = run("verify", *lines, "--work", f"{folder}/w3", *model)
    assert sum(r["count"] for r in statuses.collect()) == n

    chats = run("training-set", *lines)
    assert chats.columns == ["messages"] and chats.count() == n
    pairs = run("training-set", *lines, "--form", "completions")
    assert pairs.columns == ["prompt", "completion"] and pairs.count() == n


def test_records_of_a_single_document(spark, folder):
    problems = [{"question": "q", "answer": "a", "reasoning": "r"}] * 2
    text_file(spark, f"{folder}/problems.json", json.dumps({"problems": problems}))
    rows = jobs.load_records(spark, f"{folder}/problems.json", "documents").collect()
    names = [r.qa_key.rsplit("/", 1)[1] for r in rows]
    assert sorted(names) == ["problems.json#000000000", "problems.json#000000001"]


def test_rollouts(spark, small, folder):
    table = view(spark, small, "exam_table")
    csv_tables.write_csv(table.drop("topic_key"), f"{folder}/exams")
    outcomes = view(spark, small, "attempts").join(table.select("topic_key", "id"), "topic_key")
    outcomes.select("id", "attempt", "success").write.parquet(f"{folder}/outcomes")
    made = jobs.main(["rollouts", "--exams", f"{folder}/exams", "--outcomes", f"{folder}/outcomes",
                      "--image", "base", "--project-dir", "/srv/p", "--library-dir", "/srv/l",
                      "--out", f"{folder}/out"], spark)
    assert made.count() == outcomes.count() and "advantage" in made.columns


def test_exam_set(spark, small, folder):
    topics = [{"file_path": "a.md", "topic": {"title": f"t{i}", "description": "d"}} for i in range(9)]
    text_file(spark, f"{folder}/topics.json", json.dumps({"topics": topics}))
    outcomes = spark.createDataFrame(
        [(f"a.md:{i}", "q", 0, "s", "p", "stuck" if i == 0 else None) for i in range(9)],
        "topic_key string, question string, exit_code int, solution_commit string, "
        "problem_commit string, error string")
    outcomes.write.parquet(f"{folder}/outcomes")
    counts = jobs.main(["exam-set", "--topics", f"{folder}/topics.json", "--outcomes",
                        f"{folder}/outcomes", "--image", "base", "--model", "test_jobs:steps",
                        "--work", f"{folder}/work", "--out", f"{folder}/out"], spark)
    useful = [i for i in range(9) if M.digits("useful:", f"a.md:{i}")[0] < "c"]
    assert sum(r["count"] for r in counts.collect()) == len(useful)
    assert csv_tables.read_csv_strict(spark, f"{folder}/out", S.EXAM_ROW).count() == len(useful)


def counts_of(spark, work):
    return {r.stage: r.rows for r in spark.read.json(f"{work}/counts").collect()}


def test_exams_from_documents_in_two_runs(spark, folder):
    """Topics without an outcome wait in batches; the second run takes those that have one by then."""
    for i in range(8):
        text_file(spark, f"{folder}/docs/{i}.md", f"First part {i}.\n\nOther line {i}.\n\nThird {i}.")
    args = ["exam-set", "--documents", f"{folder}/docs", "--outcomes", f"{folder}/outcomes", "--image", "base",
            "--model", "test_jobs:steps", "--work", f"{folder}/work", "--out", f"{folder}/out", "--batch-size", "3"]
    assert jobs.main(args, spark).count() == 0
    waiting = spark.read.parquet(f"{folder}/work/waiting").collect()
    first = counts_of(spark, f"{folder}/work")
    assert first["documents"] == 8 and first["waiting"] == len(waiting) == first["useful_topics"] > 3
    assert first["extracted_topics"] == first["topics"] >= first["useful_topics"]
    in_order = sorted(waiting, key=lambda r: (r.file_pos, r.topic_pos))
    assert [r.batch_id for r in in_order] == [i // 3 for i in range(len(waiting))]

    done = [r.topic_key for r in waiting if r.batch_id == 0]
    rows = [(key, "q", 0, "s", "p", "stuck" if i == 0 else None) for i, key in enumerate(done)]
    spark.createDataFrame([*rows, ("nowhere:0", "q", 0, "s", "p", None)], S.EXAM_OUTCOME).write.parquet(f"{folder}/outcomes")
    statuses = {r.status: r["count"] for r in jobs.main(args, spark).collect()}
    assert statuses == {"generated": 2, "failed: stuck": 1}
    second = counts_of(spark, f"{folder}/work")
    assert second["waiting"] == first["waiting"] - 3 and second["outcomes_of_no_topic"] == 1
    assert (second["exams"], second["failed_exams"]) == (2, 1)
    left = {r.topic_key for r in spark.read.parquet(f"{folder}/work/waiting").collect()}
    assert left == {r.topic_key for r in waiting} - set(done)
    assert csv_tables.read_csv_strict(spark, f"{folder}/out", S.EXAM_ROW).count() == 3


def test_topics_of_a_document_have_the_keys_of_extraction(spark, folder):
    paths = ["b.md", "a.md", "b.md", "a.md", "b.md"]
    topics = [{"file_path": p, "topic": {"title": f"t{i}", "description": "d"}} for i, p in enumerate(paths)]
    text_file(spark, f"{folder}/topics.json", json.dumps({"topics": topics}))
    rows = jobs.load_topics(spark, f"{folder}/topics.json", f"{folder}/work").collect()
    assert {r.title: r.topic_key for r in rows} == {"t0": "b.md:0", "t1": "a.md:0", "t2": "b.md:1", "t3": "a.md:1", "t4": "b.md:2"}
