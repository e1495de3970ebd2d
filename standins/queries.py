"""One query per operator, with the SQL that checks it where SQL can.

The Spark side takes a view as input and goes through the library; the SQL says
what must come out.  Timestamps are compared as text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import jobs
from lectern import schemas as S
from lectern.functions import scalars, text as texts
from lectern.functions.nested import first_content, items_of_kind
from lectern.functions.structured import parse_structured
from lectern.functions.timestamps import parse_iso_timestamp
from lectern.operators import conversations, curation, exams, metrics, records, rollouts
from lectern.operators import relational as R
from lectern.operators.model_stage import RecordedModel, apply_error_policy, run_model
from lectern.plans import evaluation, exam_set as exam_plan, synthesis, training, trending
from lectern.session import apply_runtime_settings, fresh_path
from lectern.sources import corpus, csv_tables, json_records, training_sets
from lectern.sources.batches import checkpointed_batches
from lectern.sources.stages import stage_once
from lectern.streaming import conversations as live
from standins import models as M
from standins.views import spark_sql, table, view, with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

REGISTRY_CUTOFF = "1995-03-01 00:00:00"
SFT_WORDS = 100
JSON_CHARS = 500_000
CLOCK = "yyyy-MM-dd HH:mm:ss"
KEYED_QRA = T.StructType([T.StructField("qa_key", T.StringType(), False), *S.QRA.fields])


def query(sql: str | None = None, name: str | None = None, raw: bool = False) -> Callable[[Query], Query]:
    """Register a query; ``raw`` SQL has its views already."""
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_settings(spark)
            return function(spark, sf_dir)

        key = name or function.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql if raw else with_views(sql, "duckdb")
        return run

    return register


def packages(spark: SparkSession, d: str) -> DataFrame:
    return trending.with_parsed_dates(view(spark, d, "crates"))


def edges(spark: SparkSession, d: str) -> DataFrame:
    return R.edges_with_owner(view(spark, d, "dependencies"), view(spark, d, "versions"))


def edge_repositories(spark: SparkSession, d: str) -> DataFrame:
    return R.with_both_repositories(edges(spark, d), view(spark, d, "crates"))


EDGES = """edges as (
  select d.version_id, d.crate_id, v.crate_id as dependant_id
  from dependencies d join versions v on v.id = d.version_id)"""
FIRST_SEEN = """first_seen as (
  select repository, min(created_at) as repo_start_date
  from crates where repository is not null group by repository)"""


# -- sources and sinks -------------------------------------------------------

@query("""
select case when documentation is null then null else id end as id, name,
       length(readme) as readme_chars
from crates""")
def csv_lenient_scan(spark, d):
    broken = F.when(F.col("documentation").isNull(), F.concat(F.lit("x"), F.col("id")))
    path = fresh_path(spark, "csv")
    dates = F.date_format("created_at", CLOCK)
    rows = view(spark, d, "crates").withColumns({
        "id": F.coalesce(broken, F.col("id").cast("string")), "created_at": dates,
    })
    csv_tables.write_csv(rows.select(*S.CRATES.names), path)
    read = csv_tables.read_csv_lenient(spark, path, S.CRATES)
    return read.select("id", "name", F.length("readme").cast("long").alias("readme_chars"))


@query("select crate_id, downloads from crate_downloads")
def csv_strict_scan(spark, d):
    path = fresh_path(spark, "csv")
    csv_tables.write_csv(view(spark, d, "crate_downloads"), path)
    return csv_tables.read_csv_strict(spark, path, S.CRATE_DOWNLOADS)


@query("select qa_key, question, answer, reasoning from qra")
def json_records_load(spark, d):
    path = fresh_path(spark, "json")
    # A document holds the records of about so many characters of text, 50 topics of a file at
    # a time: neither a group nor the number of files per record grows with the data.
    chars = view(spark, d, "docs").agg(F.sum(F.length("text"))).first()[0] or 0
    part = F.pmod(F.xxhash64("file_path", F.floor(F.col("topic_pos") / 50)), F.lit(chars // JSON_CHARS + 1)).alias("part")
    documents = view(spark, d, "qra").groupBy(part).agg(
        F.collect_list(F.struct(*KEYED_QRA.names)).alias("problems")
    )
    json_records.save_json_documents(documents.select("problems"), path)
    return json_records.load_json_document(spark, path, KEYED_QRA).select(*KEYED_QRA.names)


@query("select qa_key, question, answer, reasoning from qra")
def json_records_roundtrip(spark, d):
    path = fresh_path(spark, "json")
    json_records.save_json_lines(view(spark, d, "qra").select(*KEYED_QRA.names), path)
    return json_records.load_json_lines(spark, path, KEYED_QRA)


@query("""
select id, topic_title, topic_description, file_path, question, solution_commit, problem_commit,
       image_name, status, image_name is null as no_image, image_name = '' as blank_image
from exam_table""")
def csv_roundtrip(spark, d):
    path = fresh_path(spark, "csv")
    csv_tables.write_csv(view(spark, d, "exam_table").select(*S.EXAM_ROW.names), path)
    return csv_tables.read_csv_strict(spark, path, S.EXAM_ROW).withColumns({
        "no_image": F.col("image_name").isNull(), "blank_image": F.col("image_name") == "",
    })


@query("""
select file_pos, coalesce(length(text) + 1, 0) as chars, md5(coalesce(text || chr(10), '')) as content
from (select file_pos, text from docs union all select -1 - file_pos, null from docs)""")
def text_corpus_load(spark, d):
    path = fresh_path(spark, "texts")
    docs = view(spark, d, "docs")
    corpus.write_texts(docs.where("text is not null"), path, "file_pos")
    place = F.regexp_extract("file_path", r"file_pos=(\d+)", 1).cast("long")
    stored = corpus.read_texts(spark, path, written=True).withColumn("file_pos", place)
    # Half of what is listed has no file.
    listed = docs.select(F.explode(F.array("file_pos", F.lit(-1) - F.col("file_pos"))).alias("file_pos"))
    return corpus.texts_of(listed, stored, "file_pos").select(
        "file_pos", F.length("text").cast("long").alias("chars"), F.md5("text").alias("content")
    )


@query("select count(*) as rows, 1 as builds from topics", name="stage_once")
def stage_once_runs(spark, d):
    path, builds = fresh_path(spark, "stage"), []

    def build():
        builds.append(1)
        return view(spark, d, "topics")

    topics = view(spark, d, "topics")
    stage_once(spark, path, build, [topics])
    again = stage_once(spark, path, build, [topics])
    return again.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(builds)).alias("builds"))


@query("""
select topic_key,
       (row_number() over (order by file_pos, topic_pos) - 1) // 2000 as batch_id
from topics""", name="checkpointed_batches")
def checkpointed_batches_twice(spark, d):
    path, order = fresh_path(spark, "batches"), ["file_pos", "topic_pos"]
    topics = view(spark, d, "topics")
    checkpointed_batches(topics, path, order, 2000)
    return checkpointed_batches(topics, path, order, 2000).select(
        "topic_key", F.col("batch_id").cast("long").alias("batch_id")
    )


@query(f"""
select qa_key, '{texts.DEFAULT_SYSTEM_PROMPT}' as system_text, question as user_text,
       concat('<think>', reasoning, '</think>', answer) as assistant_text
from qra""")
def sft_parquet_roundtrip(spark, d):
    path = fresh_path(spark, "sft")
    training_sets.write_training_set(records.as_conversational(view(spark, d, "qra"), "qa_key"), path)
    return flat_messages(training_sets.read_training_set(spark, path))


# -- projections, filters, scalar functions ----------------------------------

@query("select id as crate_id, repository as repo from crates")
def project_rename(spark, d):
    return R.project(view(spark, d, "crates"), crate_id="id", repo="repository")


@query("select id, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at from crates",
       name="parse_iso_timestamp")
def parse_iso_timestamp_text(spark, d):
    zone = F.element_at(F.array(F.lit("+00"), F.lit("Z"), F.lit("")), (F.col("id") % 3 + 1).cast("int"))
    written = F.coalesce(F.concat(F.date_format("created_at", CLOCK), zone), F.lit("garbage"))
    dated = view(spark, d, "crates").select("id", written.alias("created_at"))
    return dated.select("id", F.date_format(parse_iso_timestamp("created_at"), CLOCK).alias("created_at"))


@query("select id from crates where documentation is not null and homepage is not null")
def filter_conjunction(spark, d):
    present = [F.col("documentation").isNotNull(), F.col("homepage").isNotNull()]
    return R.where_all(view(spark, d, "crates"), *present).select("id")


@query("select doc_id, length(text) as chars from documents where length(text) > 100")
def char_length_filter(spark, d):
    long_ones = table(spark, d, "documents").where(scalars.longer_than("text", 100))
    return long_ones.select("doc_id", F.length("text").cast("long").alias("chars"))


@query(f"""
with {FIRST_SEEN}
select repository, strftime(repo_start_date, '%Y-%m-%d %H:%M:%S') as repo_start_date
from first_seen where repo_start_date >= timestamp '{REGISTRY_CUTOFF}'""")
def timestamp_cutoff(spark, d):
    fresh = R.since(R.first_seen(packages(spark, d)), "repo_start_date", REGISTRY_CUTOFF)
    return fresh.select("repository", F.date_format("repo_start_date", CLOCK).alias("repo_start_date"))


@query(f"""
with {EDGES}
select e.crate_id, e.dependant_id from edges e
join crates t on t.id = e.crate_id join crates s on s.id = e.dependant_id
where t.repository = s.repository""")
def same_group_edges(spark, d):
    return R.same_repository(edge_repositories(spark, d)).select("crate_id", "dependant_id")


@query("""
select c.id, coalesce(w.downloads, 0) as downloads, c.homepage
from crates c left join crate_downloads w on w.crate_id = c.id""")
def fill_numeric_nulls(spark, d):
    loads = R.project(view(spark, d, "crate_downloads"), id="crate_id", downloads="downloads")
    joined = view(spark, d, "crates").join(loads, "id", "left")
    return scalars.fill_numeric_nulls(joined.select("id", "downloads", "homepage"))


@query("""
select topic_key, case when image_name is null or image_name = '' then 'base' else image_name end
         as image_name
from exam_table""")
def default_when_empty(spark, d):
    image = scalars.default_when_empty("image_name", "base")
    return view(spark, d, "exam_table").select("topic_key", image.alias("image_name"))


@query("""
select topic_key, title, description from topics
where topic_key = (select min(topic_key) from topics)""")
def lookup_by_id(spark, d):
    topics = view(spark, d, "topics")
    wanted = topics.agg(F.min("topic_key")).first()[0]
    found = R.lookup_by_id(topics, wanted, "topic_key", ["file_pos", "topic_pos"])
    return found.select("topic_key", "title", "description")


@query("select topic_key from exam_table where status = 'generated'")
def status_filter(spark, d):
    return R.with_status(view(spark, d, "exam_table")).select("topic_key")


@query("""
select topic_key,
       regexp_replace(md5(topic_key), '(.{8})(.{4})(.{4})(.{4})(.{12})', 'exam-\\1-\\2-\\3-\\4-\\5')
         as id
from topics""")
def prefixed_id(spark, d):
    return view(spark, d, "topics").select(
        "topic_key", scalars.prefixed_id("topic_key", "exam").alias("id")
    )


@query("select file_path, string_split(file_path, '/')[-1] as name from docs")
def path_basename(spark, d):
    return view(spark, d, "docs").select(
        "file_path", scalars.path_basename("file_path").alias("name")
    )


PROMPT_LINES = "Title: {title}\nDescription: {description}\nRecord: {key}"


@query("""
select topic_key, md5(concat('Title: ', title, chr(10), 'Description: ', description, chr(10),
                             'Record: ', topic_key)) as prompt
from topics""")
def render_prompt(spark, d):
    prompt = texts.render_prompt(
        PROMPT_LINES, title="title", description="description", key="topic_key"
    )
    return view(spark, d, "topics").select("topic_key", F.md5(prompt).alias("prompt"))


@query("""
select qa_key, md5(concat_ws(chr(10), concat('## ', qa_key), '### Problem Statement', question,
  '### Canonical Solution', '```python', answer, '```', '### Test Code', '```python',
  topic_key, '```', '')) as markdown
from qa""")
def problem_markdown(spark, d):
    page = texts.problem_markdown("qa_key", "question", "answer", "topic_key")
    return view(spark, d, "qa").select("qa_key", F.md5(page).alias("markdown"))


@query("""
select qa_key, question as prompt,
       concat('<think>', chr(10), reasoning, chr(10), '</think>', chr(10), chr(10), answer)
         as completion,
       concat('<think>', reasoning, '</think>', answer) as message
from qra""")
def prompt_completion(spark, d):
    qra = view(spark, d, "qra")
    message = texts.thinking_message("reasoning", "answer").alias("message")
    return records.as_prompt_completion(qra.withColumn("message", message), "qa_key", "message")


@query("""
select topic_key, file_path, title, description, 'lib' as library, '/srv/lib' as library_dir
from topics""")
def assemble_record(spark, d):
    library = F.struct(F.lit("lib").alias("name"), F.lit("/srv/lib").alias("local_dir"))
    built = records.topic_entities(view(spark, d, "topics")).withColumn("library", library)
    return built.select(
        "topic_key", "file_path", "topic.title", "topic.description",
        F.col("library.name").alias("library"), F.col("library.local_dir").alias("library_dir"),
    )


@query("""
select topic_key, exit_code = 0 as is_success,
       concat(coalesce(stdout, ''), coalesce(stderr, '')) as output
from exam_candidates""")
def outcome_label(spark, d):
    return view(spark, d, "exam_candidates").select(
        "topic_key", *scalars.run_outcome("exit_code", "stdout", "stderr")
    )


@query("""
select topic_key, case when error is null then 'generated' else concat('failed: ', error) end
         as status
from exam_candidates""")
def failure_status(spark, d):
    return view(spark, d, "exam_candidates").select(
        "topic_key", scalars.generation_status("error").alias("status")
    )


@query("select doc_id, strlen(text) as text_bytes from documents")
def scalar_udf(spark, d):
    measure = scalars.vectorised(lambda value: len(value.encode()), "long")
    return table(spark, d, "documents").select("doc_id", measure("text").alias("text_bytes"))


# -- joins -------------------------------------------------------------------

@query(f"""
with {FIRST_SEEN}
select c.id, c.repository, strftime(f.repo_start_date, '%Y-%m-%d %H:%M:%S') as repo_start_date
from crates c join first_seen f on f.repository = c.repository""")
def join_inner(spark, d):
    rows = packages(spark, d)
    return R.join_per_key(rows, R.first_seen(rows), "repository").select(
        "id", "repository", F.date_format("repo_start_date", CLOCK).alias("repo_start_date")
    )


@query(f"""
with {EDGES}
select crate_id, dependant_id, count(*) as edges from edges group by crate_id, dependant_id""")
def join_edge_owner(spark, d):
    return edges(spark, d).groupBy("crate_id", "dependant_id").agg(F.count("*").alias("edges"))


@query(f"""
with {EDGES}
select e.crate_id, t.repository as target_repo, s.repository as dependant_repo, count(*) as edges
from edges e join crates t on t.id = e.crate_id join crates s on s.id = e.dependant_id
group by e.crate_id, t.repository, s.repository""")
def join_both_endpoints(spark, d):
    keys = ["crate_id", "target_repo", "dependant_repo"]
    return edge_repositories(spark, d).groupBy(*keys).agg(F.count("*").alias("edges"))


@query(f"""
with {EDGES},
dependants as (
  select crate_id, count(distinct dependant_id) as n from edges group by crate_id)
select c.id, w.downloads, n.n as direct_dependant_count
from crates c left join crate_downloads w on w.crate_id = c.id
left join dependants n on n.crate_id = c.id""")
def join_left_metrics(spark, d):
    dependants = R.distinct_count(
        edges(spark, d), "crate_id", "dependant_id", "direct_dependant_count"
    )
    joined = R.with_metrics(view(spark, d, "crates"), view(spark, d, "crate_downloads"), dependants)
    return joined.select("id", "downloads", "direct_dependant_count")


@query(f"""
with {EDGES},
internal as (
  select e.crate_id from edges e
  join crates t on t.id = e.crate_id join crates s on s.id = e.dependant_id
  where t.repository = s.repository)
select c.id from crates c
where c.id is not null and not exists (select 1 from internal i where i.crate_id = c.id)""")
def join_anti(spark, d):
    internal = R.same_repository(edge_repositories(spark, d))
    return R.without_listed(view(spark, d, "crates"), "id", internal, "crate_id").select("id")


@query("select topic_key, title, is_useful from judged_topics")
def zip_by_key(spark, d):
    verdicts = view(spark, d, "judged_topics").select("topic_key", "is_useful")
    paired = R.zip_by_key(view(spark, d, "topics"), verdicts, "topic_key")
    return paired.select("topic_key", "title", "is_useful")


# -- aggregates, order, limits -----------------------------------------------

@query(f"""
with {FIRST_SEEN}
select repository, strftime(repo_start_date, '%Y-%m-%d %H:%M:%S') as repo_start_date
from first_seen""")
def agg_first_seen(spark, d):
    first = R.first_seen(packages(spark, d))
    return first.select("repository", F.date_format("repo_start_date", CLOCK).alias("repo_start_date"))


@query(f"""
with {EDGES}
select crate_id, count(distinct dependant_id) as dependants from edges group by crate_id""")
def agg_distinct_count(spark, d):
    return R.distinct_count(edges(spark, d), "crate_id", "dependant_id", "dependants")


@query(f"with {EDGES} select distinct crate_id, dependant_id from edges")
def distinct_rows(spark, d):
    return R.distinct_rows(edges(spark, d), "crate_id", "dependant_id")


@query("""
select count(*) as total, count(*) filter (is_correct) as correct,
       round(100.0 * count(*) filter (is_correct) / count(*), 6) as accuracy
from solve_results""")
def accuracy_summary(spark, d):
    summary = metrics.accuracy_summary(view(spark, d, "solve_results"))
    return summary.withColumn("accuracy", F.round("accuracy", 6))


FUNNEL = ["docs", "useful_docs", "topics", "qa", "qra", "solve_results", "exam_table"]


@query("\nunion all ".join(
    f"select {i} as stage_pos, '{name}' as stage, count(*) as rows from {name}"
    for i, name in enumerate(FUNNEL)
))
def stage_funnel(spark, d):
    return metrics.stage_funnel(**{name: view(spark, d, name) for name in FUNNEL})


@query(f"""
with {EDGES}
select crate_id, count(distinct dependant_id) as dependants from edges group by crate_id
order by dependants desc, crate_id limit 20""")
def topk_desc(spark, d):
    counts = R.distinct_count(edges(spark, d), "crate_id", "dependant_id", "dependants")
    return R.top_k(counts, "dependants", 20, "crate_id")


@query("select question, qa_key from qra order by question, qa_key limit 12")
def sort_head(spark, d):
    return R.sorted_head(view(spark, d, "qra").select("question", "qa_key"), 12, "question", "qa_key")


@query("select topic_key, title from topics order by file_pos, topic_pos limit 30")
def input_prefix(spark, d):
    first = R.input_prefix(view(spark, d, "topics"), 30, "file_pos", "topic_pos")
    return first.select("topic_key", "title")


@query("""
select topic_key from exam_table where status = 'generated'
order by md5(concat(topic_key, '#7')), topic_key limit 1""")
def sample_one(spark, d):
    return R.sample_one(R.with_status(view(spark, d, "exam_table")), "topic_key", 7).select("topic_key")


# -- nested ------------------------------------------------------------------

def answer_items(spark: SparkSession, d: str) -> DataFrame:
    """Records with an array of items, the reasoning item absent by hash."""
    def item(kind, content):
        return F.struct(F.lit(kind).alias("kind"), content.alias("content"))

    present = F.substring(F.md5(F.concat(F.lit("item:"), F.col("qa_key"))), 1, 1) < "8"
    message = item("message", F.col("answer"))
    items = F.when(present, F.array(item("reasoning", F.col("reasoning")), message))
    return view(spark, d, "qra").withColumn("items", items.otherwise(F.array(message)))


@query("""
select qa_key,
       case when substr(md5(concat('item:', qa_key)), 1, 1) < '8' then reasoning else '' end
         as agent_reasoning
from qra""")
def first_or_default(spark, d):
    return answer_items(spark, d).select(
        "qa_key", first_content("items", "reasoning").alias("agent_reasoning")
    )


@query("""
select qa_key, 1 as messages,
       case when substr(md5(concat('item:', qa_key)), 1, 1) < '8' then 1 else 0 end as reasonings
from qra""")
def array_filter_kind(spark, d):
    return answer_items(spark, d).select(
        "qa_key",
        F.size(items_of_kind("items", "message")).alias("messages"),
        F.size(items_of_kind("items", "reasoning")).alias("reasonings"),
    )


@query("select file_path, topic_pos, title from topics")
def explode_topics(spark, d):
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(line) > 0)
    topics = F.transform(lines, lambda line: F.struct(
        F.split_part(line, F.lit("."), F.lit(1)).alias("title"), line.alias("description")
    ))
    nested = view(spark, d, "docs").select("file_path", topics.alias("topics"))
    rows = R.explode_with_parent(nested, "topics", "topic_pos", "topic")
    return rows.select("file_path", F.col("topic_pos").cast("long").alias("topic_pos"), "topic.title")


@query("select topic_key, status from exam_table")
def union_results(spark, d):
    table_ = view(spark, d, "exam_table").select("topic_key", "status")
    good, bad = R.with_status(table_), table_.where(F.col("status") != "generated")
    return R.union_results(good, None, bad.select("status", "topic_key"))


def flat_messages(df: DataFrame, *keep: str) -> DataFrame:
    names = ["system_text", "user_text", "assistant_text"]
    return df.select("qa_key", *keep, *[
        F.col("messages")[i]["content"].alias(name) for i, name in enumerate(names)
    ])


@query(f"""
select qa_key, 'system,user,assistant' as roles, '{texts.DEFAULT_SYSTEM_PROMPT}' as system_text,
       question as user_text, concat('<think>', reasoning, '</think>', answer) as assistant_text
from qra""")
def chat_messages(spark, d):
    chats = records.as_conversational(view(spark, d, "qra"), "qa_key")
    roles = chats.select("qa_key", F.array_join("messages.role", ",").alias("roles"), "messages")
    return flat_messages(roles, "roles")


# -- model steps -------------------------------------------------------------

USEFULNESS_REPLY = """concat('{"is_useful": ', case when is_useful then 'true' else 'false' end,
  ', "reason": "by hash"}')"""


def judge_prompt():
    return texts.render_prompt(
        curation.JUDGE_TOPIC, title="title", description="description", key="topic_key"
    )


@query(f"select topic_key, {USEFULNESS_REPLY} as response, 1 as attempts from judged_topics")
def model_stage(spark, d):
    def build():
        return run_model(view(spark, d, "topics"), "topic_key", judge_prompt(), M.model(M.Usefulness))

    staged = stage_once(spark, fresh_path(spark, "model"), build)
    return staged.select("topic_key", "response", "attempts")


@query("""
select topic_key, case when substr(md5(topic_key), 1, 1) < 'e' then concat('seen ', topic_key) end
         as response,
       case when substr(md5(topic_key), 1, 1) < 'e' then 1 else 0 end as attempts,
       case when substr(md5(topic_key), 1, 1) < 'e' then null else 'missing' end as error_kind
from topics""")
def model_stage_recorded(spark, d):
    topics = view(spark, d, "topics")
    kept = topics.where(F.substring(F.md5("topic_key"), 1, 1) < "e")
    recorded = kept.select(
        F.sha2(judge_prompt(), 256).alias("prompt_hash"),
        F.concat(F.lit("seen "), F.col("topic_key")).alias("response"),
    )
    answered = run_model(topics, "topic_key", judge_prompt(), RecordedModel(recorded))
    return answered.select("topic_key", "response", "attempts", "error_kind")


@query("select file_path from useful_docs")
def select_documents(spark, d):
    judged = curation.select_documents(
        view(spark, d, "docs").select("file_path"), M.model(M.DocumentChoice), fresh_path(spark, "m1")
    )
    return apply_error_policy(judged, "fail").where("is_useful").select("file_path")


@query("select topic_key, title, description from topics")
def extract_topics(spark, d):
    extracted = curation.extract_topics(
        view(spark, d, "docs"), M.model(M.TopicExtraction), fresh_path(spark, "m2")
    )
    return curation.topic_rows(extracted).select("topic_key", "title", "description")


@query("select topic_key from judged_topics where is_useful")
def filter_useful_topics(spark, d):
    judged = curation.judge_topics(
        view(spark, d, "topics"), M.model(M.Usefulness), fresh_path(spark, "m3")
    )
    return apply_error_policy(judged, "fail").where("is_useful").select("topic_key")


@query("""
select topic_key, case when substr(md5(concat('type:', topic_key)), 1, 1) < '8' then 'programming'
                       else 'qa' end as problem_type
from topics""")
def dispatch_problem_type(spark, d):
    return curation.dispatch_problem_type(
        view(spark, d, "topics"), M.model(M.ProblemType), fresh_path(spark, "m4")
    ).select("topic_key", "problem_type")


def asked_topics(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "judged_topics").where("is_useful").select(
        "file_pos", "file_path", "topic_pos", "topic_key", "title", "description"
    )


def generated(spark, d, kind: type = M.Questions, max_items: int | None = None) -> DataFrame:
    return curation.generate_qa(
        asked_topics(spark, d), M.model(kind, 3), fresh_path(spark, "qa"), max_items
    )


@query("select qa_key, question, answer from qa where qa_pos = 0")
def generate_qa_single(spark, d):
    single = apply_error_policy(generated(spark, d, max_items=1), "drop_row")
    return curation.qa_rows(single).select("qa_key", "question", "answer")


@query("select qa_key, question, answer from qa")
def generate_qa(spark, d):
    several = apply_error_policy(generated(spark, d), "drop_row")
    return curation.qa_rows(several).select("qa_key", "question", "answer")


@query("select qa_key, reasoning from qra")
def hindsight_reasoning(spark, d):
    reasoned = curation.hindsight_reasoning(
        view(spark, d, "qa"), M.model(M.Reasoning, 3), fresh_path(spark, "m7")
    )
    kept = apply_error_policy(reasoned, "drop_row").where(F.col("reasoning").isNotNull())
    return kept.select("qa_key", "reasoning")


@query("""
select qa_key, concat('Re: ', question) as agent_answer,
       case when substr(md5(concat('item:', qa_key)), 1, 1) < '8' then concat('Think ', question)
            else '' end as agent_reasoning
from qra where substr(md5(concat('solve:', qa_key)), 3, 1) <> '0'""")
def answer_questions(spark, d):
    answered = curation.answer_questions(
        view(spark, d, "qra"), M.model(M.Solver), fresh_path(spark, "m8")
    )
    good = apply_error_policy(answered, "drop_row")
    return good.select("qa_key", "agent_answer", "agent_reasoning")


@query("select qa_key, is_correct from solve_results")
def judge_answers(spark, d):
    judged = curation.judge_answers(
        view(spark, d, "solve_results").drop("is_correct"), M.model(M.AnswerJudge),
        fresh_path(spark, "m9"),
    )
    return apply_error_policy(judged, "drop_row").select("qa_key", "is_correct")


@query("select qa_key, substr(md5(concat('verify:', qa_key)), 1, 1) < 'c' as is_valid from qra")
def verify_qra(spark, d):
    checked = curation.verify_records(
        view(spark, d, "qra"), M.model(M.RecordJudge), fresh_path(spark, "m10")
    )
    return checked.select("qa_key", "is_valid")


@query("""
select topic_key, shape not in ('0', '1', '2', '3', '4') as valid,
       case when shape = '5' then true when shape > '5' then false end as is_useful
from raw_responses""", name="parse_structured")
def parse_structured_responses(spark, d):
    parsed = parse_structured(view(spark, d, "raw_responses"), "response", S.USEFULNESS)
    return parsed.select("topic_key", "valid", "parsed.is_useful")


@query("""
select topic_key, least(attempts_needed, 3) as attempts, attempts_needed <= 3 as succeeded
from judged_topics where is_useful""")
def model_retry(spark, d):
    return generated(spark, d).select(
        "topic_key", "attempts", F.col("error").isNull().alias("succeeded")
    )


@query("select count(*) as rows, 3 as partitions from topics")
def bounded_concurrency(spark, d):
    topics = view(spark, d, "topics").select("topic_key", "title", "description")
    called = run_model(
        topics, "topic_key", judge_prompt(), M.model(M.Usefulness), concurrency=3, placed="part"
    )
    staged = stage_once(spark, fresh_path(spark, "bounded"), lambda: called.select("response", "part"))
    per_part = staged.groupBy("part").agg(F.count("*").alias("n"))
    return per_part.agg(F.sum("n").alias("rows"), F.count("*").cast("int").alias("partitions"))


@query("""
with calls as (
  select topic_key, file_path, substr(md5(topic_key), 31, 2) = 'ff' as broken,
         attempts_needed > 3 as gave_up
  from judged_topics where is_useful),
broken_files as (select distinct file_path from calls where broken)
select 'drop_row' as policy, topic_key, 'generated' as status
from calls where not broken and not gave_up
union all
select 'drop_group', topic_key, 'generated'
from calls where not broken and not gave_up
  and file_path not in (select file_path from broken_files)
union all
select 'status_row', topic_key,
       case when broken then 'failed: ValueError: broken record'
            when gave_up then 'failed: ModelCallError: agent run failed' else 'generated' end
from calls""")
def error_policy(spark, d):
    calls = generated(spark, d, M.FaultyQuestions)
    ok = F.lit("generated").alias("status")
    by_row = apply_error_policy(calls, "drop_row").select("topic_key", ok)
    by_file = apply_error_policy(calls, "drop_group", "file_path").select("topic_key", ok)
    with_text = apply_error_policy(calls, "status_row").select("topic_key", "status")
    return R.union_results(*[
        part.withColumn("policy", F.lit(name))
        for name, part in [("drop_row", by_row), ("drop_group", by_file), ("status_row", with_text)]
    ])


# -- conversations -----------------------------------------------------------

@query("""
select conv_id, turn as stuck_turn from (
  select conv_id, turn, row_number() over (partition by conv_id order by turn) as n
  from conversation_events where text like '%[no text content]%')
where n = 2""")
def stuck_conversations(spark, d):
    return conversations.stuck_conversations(view(spark, d, "conversation_events"), 1)


@query("""
select conv_id from conversation_events where text like '%[no text content]%'
group by conv_id having count(*) > 1""")
def stuck_conversations_stream(spark, d):
    source, work = fresh_path(spark, "events"), fresh_path(spark, "stream")
    events = view(spark, d, "conversation_events")
    # Spread by conversation and turn, so that one conversation arrives in several micro-batches.
    tasks = spark.sparkContext.defaultParallelism
    events.repartition(tasks, "conv_id", "turn").write.parquet(source)
    session = live.stream_session(spark, tasks)
    arriving = (
        session.readStream.schema(events.schema).option("maxFilesPerTrigger", -(-tasks // 3)).parquet(source)
    )
    run = live.alert_once(arriving, f"{work}/alerts", f"{work}/state", 1, available_now=True)
    run.awaitTermination()
    return live.read_alerts(spark, f"{work}/alerts").select("conv_id")


# -- exams and rollouts ------------------------------------------------------

@query("""
select topic_key, case when exit_code <> 0 then 'tests failed'
                       when solution_commit is null then 'no solution commit'
                       when problem_commit is null then 'no problem commit' end as reject_reason
from exam_candidates""")
def exam_gate(spark, d):
    return exams.exam_gate(view(spark, d, "exam_candidates")).select("topic_key", "reject_reason")


@query("""
select id, case when image_name is null or image_name = '' then 'base' else image_name end
         as image_name,
       'practice' as project_name, 'lib' as library_name, question
from exam_table where status = 'generated'""")
def load_exams(spark, d):
    path = fresh_path(spark, "csv")
    csv_tables.write_csv(view(spark, d, "exam_table").select(*S.EXAM_ROW.names), path)
    rows = csv_tables.read_csv_strict(spark, path, S.EXAM_ROW)
    loaded = exams.load_exams(rows, "base", "/srv/practice/", "/srv/lib")
    return loaded.select(
        "id", "image_name", F.col("project.name").alias("project_name"),
        F.col("library.name").alias("library_name"), "question",
    )


@query("""
select with_library, count(*) as n, count(*) filter (success) as successes,
       round(1.0 * count(*) filter (success) / count(*), 6) as solve_rate
from attempts group by with_library""")
def solve_rate(spark, d):
    rates = exams.solve_rate(view(spark, d, "attempts"))
    return rates.withColumn("solve_rate", F.round("solve_rate", 6))


@query("select topic_key, attempt, case when success then 1.0 else 0.0 end::double as reward from attempts")
def rollout_rewards(spark, d):
    tasks = R.with_status(view(spark, d, "exam_table")).select("topic_key")
    return rollouts.rollout_rewards(tasks, view(spark, d, "attempts"), "topic_key")


ADVANTAGES = """
  select topic_key, attempt, case when success then 1.0 else 0.0 end::double as reward,
         avg(success::int) over (partition by topic_key) as mean,
         stddev_samp(success::int) over (partition by topic_key) as deviation
  from attempts"""


@query(f"""
select topic_key, attempt,
       round(case when deviation = 0 then 0.0 else (reward - mean) / deviation end, 6) as advantage
from ({ADVANTAGES})""")
def group_advantage(spark, d):
    rewards = view(spark, d, "attempts").select(
        "topic_key", "attempt", F.col("success").cast("double").alias("reward")
    )
    scored = rollouts.group_advantage(rewards, "topic_key")
    return scored.select("topic_key", "attempt", F.round("advantage", 6).alias("advantage"))


@query("""
select 'drop' as handling, doc_id, length(text) as chars from documents where length(text) <= 2000
union all
select 'truncate', doc_id, least(length(text), 2000) from documents""")
def length_budget(spark, d):
    documents = table(spark, d, "documents")
    by_chars = partial(
        rollouts.length_budget, documents, "text", 2000, "doc_id",
        measure=F.length, cut=lambda text, limit: F.substring(text, 1, limit),
    )
    return R.union_results(*[
        by_chars(on_exceed=way).select(
            F.lit(way).alias("handling"), "doc_id", F.length("text").cast("long").alias("chars")
        )
        for way in ("drop", "truncate")
    ])


# -- whole workflows ---------------------------------------------------------

@query(f"""
with {EDGES}, {FIRST_SEEN},
dependants as (
  select crate_id, count(distinct dependant_id) as n from edges group by crate_id),
internal as (
  select e.crate_id from edges e
  join crates t on t.id = e.crate_id join crates s on s.id = e.dependant_id
  where t.repository = s.repository)
select c.name, strftime(c.created_at, '%Y-%m-%d %H:%M:%S') as created_at,
       coalesce(n.n, 0) as direct_dependant_count, coalesce(w.downloads, 0) as downloads,
       c.description, c.repository, c.homepage, c.documentation
from crates c join first_seen f on f.repository = c.repository
left join crate_downloads w on w.crate_id = c.id
left join dependants n on n.crate_id = c.id
where f.repo_start_date >= timestamp '{REGISTRY_CUTOFF}'
  and length(c.description) > 10 and c.documentation is not null and c.homepage is not null
  and length(c.readme) > 100
  and not exists (select 1 from internal i where i.crate_id = c.id)
order by direct_dependant_count desc, c.id limit 20""")
def trending_packages(spark, d):
    inputs = [view(spark, d, n) for n in ("crates", "crate_downloads", "dependencies", "versions")]
    best = trending.trending_packages(*inputs, cutoff=REGISTRY_CUTOFF)
    return best.withColumn("created_at", F.date_format("created_at", CLOCK))


def synthesis_models() -> synthesis.SynthesisModels:
    return synthesis.SynthesisModels(
        M.model(M.DocumentChoice), M.model(M.TopicExtraction), M.model(M.Usefulness),
        M.model(M.Questions, 3), M.model(M.Reasoning, 3),
    )


#: What the stand-in for the selection of documents keeps.
SELECTED = "file_path in (select file_path from useful_docs)"


@query(f"select qa_key, question, answer, reasoning from qra where {SELECTED}")
def qra_synthesis(spark, d):
    made = synthesis.qra_records(
        view(spark, d, "docs"), synthesis_models(), fresh_path(spark, "synthesis"), max_topics=None
    )
    return made.select("qa_key", "question", "answer", "reasoning")


@query("""
select count(*) as total, count(*) filter (is_correct) as correct,
       round(100.0 * count(*) filter (is_correct) / count(*), 6) as accuracy
from solve_results""")
def qra_evaluation(spark, d):
    work = fresh_path(spark, "evaluation")
    judged = evaluation.evaluate_records(
        view(spark, d, "qra"), M.model(M.Solver), M.model(M.AnswerJudge), work, limit=None
    )
    _, summary = evaluation.evaluation_report(judged, work)
    return summary.withColumn("accuracy", F.round("accuracy", 6))


@query("""
select qa_key,
       case when substr(md5(concat('verify:', qa_key)), 1, 1) < 'c' then '✅ [VALID]'
            else '❌ [INVALID]' end as status,
       case when substr(md5(concat('verify:', qa_key)), 1, 1) < 'c' then 'sound'
            else 'gap in the reasoning' end as feedback
from qra""")
def qra_verification_report(spark, d):
    report = evaluation.verification_report(
        view(spark, d, "qra"), M.model(M.RecordJudge), fresh_path(spark, "verification")
    )
    return report.select("qa_key", "status", "feedback")


@query("select topic_key, id, question, solution_commit, problem_commit, status from exam_table")
def exam_set(spark, d):
    made = exam_plan.exam_set(
        view(spark, d, "topics"), view(spark, d, "exam_candidates"), M.model(M.Usefulness),
        F.lit("base"), fresh_path(spark, "exams"), max_topics=None,
    )
    return made.select("topic_key", "id", "question", "solution_commit", "problem_commit", "status")


@query(f"""
select qa_key, '{texts.DEFAULT_SYSTEM_PROMPT}' as system_text, question as user_text,
       concat('<think>', reasoning, '</think>', answer) as assistant_text
from qra
where length(concat('{texts.DEFAULT_SYSTEM_PROMPT}', chr(10), question, chr(10),
                    '<think>', reasoning, '</think>', answer)) <= 400""")
def sft_dataset(spark, d):
    path = fresh_path(spark, "sft")
    kept = training.training_set(view(spark, d, "qra"), "qa_key", 400, "drop", measure=F.length)
    training_sets.write_training_set(kept, path)
    return flat_messages(training_sets.read_training_set(spark, path))


@query(f"""
select e.id, a.attempt, a.reward,
       round(case when a.deviation = 0 then 0.0 else (a.reward - a.mean) / a.deviation end, 6)
         as advantage
from exam_table e join ({ADVANTAGES}) a on a.topic_key = e.topic_key""")
def rollout_dataset(spark, d):
    rows = view(spark, d, "exam_table")
    outcomes = view(spark, d, "attempts").join(rows.select("topic_key", "id"), "topic_key")
    made = training.rollout_set(rows, outcomes, "base", "/srv/practice", "/srv/lib")
    return made.select("id", "attempt", "reward", F.round("advantage", 6).alias("advantage"))


# -- whole workflows from files to files -------------------------------------

def run_job(spark: SparkSession, *args: str) -> str:
    """Run a job as from the shell; returns its output folder."""
    out = fresh_path(spark, "out")
    given = jobs.parser().parse_args([*args, "--out", out])
    given.job(spark, given)
    return out


def model_job(spark: SparkSession, *args: str) -> str:
    return run_job(spark, *args, "--work", fresh_path(spark, "work"), "--model", "standins.models:STEPS")


def packed_docs(spark: SparkSession, d: str) -> str:
    path = fresh_path(spark, "packed")
    corpus.write_packed(view(spark, d, "docs"), path, "gzip")
    return path


def qra_lines(spark: SparkSession, d: str) -> str:
    path = fresh_path(spark, "records")
    json_records.save_json_lines(view(spark, d, "qra").select(*KEYED_QRA.names), path, "gzip")
    return path


@query("""
select file_path, length(text) as chars, md5(text) as content from docs where text is not null""")
def packed_corpus_roundtrip(spark, d):
    path = fresh_path(spark, "packed")
    corpus.write_packed(view(spark, d, "docs").where("text is not null"), path)
    return corpus.read_packed(spark, path).select(
        "file_path", F.length("text").cast("long").alias("chars"), F.md5("text").alias("content"))


@query(ORACLES["qra_synthesis"], raw=True)
def qra_synthesis_files(spark, d):
    out = model_job(spark, "synthesise", "--documents", packed_docs(spark, d), "--documents-as", "packed", "--batch-size", "20000")
    return json_records.load_json_lines(spark, out, KEYED_QRA).select("qa_key", "question", "answer", "reasoning")


@query(ORACLES["qra_evaluation"], raw=True)
def qra_evaluation_files(spark, d):
    out = model_job(spark, "evaluate", "--records", qra_lines(spark, d), "--layout", "lines")
    written = json_records.load_json_lines(spark, out, S.SOLVE_RESULT)
    return metrics.accuracy_summary(written).withColumn("accuracy", F.round("accuracy", 6))


@query(ORACLES["qra_verification_report"], raw=True)
def qra_verification_files(spark, d):
    out = model_job(spark, "verify", "--records", qra_lines(spark, d), "--layout", "lines")
    return spark.read.schema("qa_key string, status string, feedback string").json(out)


@query(f"select id, topic_title, file_path, question, solution_commit, problem_commit, status from exam_table where {SELECTED}")
def exam_set_files(spark, d):
    outcomes = fresh_path(spark, "outcomes")
    view(spark, d, "exam_candidates").write.parquet(outcomes)
    out = model_job(spark, "exam-set", "--documents", packed_docs(spark, d), "--documents-as", "packed",
                    "--outcomes", outcomes, "--image", "base")
    return csv_tables.read_csv_strict(spark, out, S.EXAM_ROW).select(
        "id", "topic_title", "file_path", "question", "solution_commit", "problem_commit", "status")


@query(f"""
select '{texts.DEFAULT_SYSTEM_PROMPT}' as system_text, question as user_text,
       concat('<think>', reasoning, '</think>', answer) as assistant_text
from qra
where len(regexp_extract_all(concat('{texts.DEFAULT_SYSTEM_PROMPT}', chr(10), question, chr(10), '<think>', reasoning,
                                    '</think>', answer), '[^ \\n]+')) <= {SFT_WORDS}""")
def sft_dataset_files(spark, d):
    out = run_job(spark, "training-set", "--records", qra_lines(spark, d), "--layout", "lines",
                  "--max-length", str(SFT_WORDS), "--on-exceed", "drop")
    return flat_messages(training_sets.read_training_set(spark, out).withColumn("qa_key", F.lit(0))).drop("qa_key")


@query(ORACLES["rollout_dataset"], raw=True)
def rollout_dataset_files(spark, d):
    table, outcomes = fresh_path(spark, "exams"), fresh_path(spark, "outcomes")
    rows = view(spark, d, "exam_table")
    csv_tables.write_csv(rows.select(*S.EXAM_ROW.names), table)
    view(spark, d, "attempts").join(rows.select("topic_key", "id"), "topic_key").select("id", "attempt", "success").write.parquet(outcomes)
    out = run_job(spark, "rollouts", "--exams", table, "--outcomes", outcomes, "--image", "base",
                  "--project-dir", "/srv/practice", "--library-dir", "/srv/lib")
    return spark.read.parquet(out).select("id", "attempt", "reward", F.round("advantage", 6).alias("advantage"))
