"""Views that give the library's input schemas from the test tables.

Most of the SQL runs unchanged in Spark and DuckDB; where the dialects differ a
view has one text for each.  All views run over whole tables and whole texts.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

VIEWS: dict[str, str | dict[str, str]] = {
    # Spark computes nothing before a join that is asked for after it: the description
    # is made first, so that the whole text goes along only where it is read.
    "crates": {
        dialect: f"""
select c.c_custkey as id,
       c.c_name as name,
       case when c.c_nationkey <> 3
            then concat('https://git.example/', cast(cast(floor(c.c_custkey / 3.0) as bigint) as varchar(20)))
            end as repository,
       case when c.c_nationkey <> 11 then o.first_order end as created_at,
       {description} as description,
       d.text as readme,
       case when c.c_acctbal >= 0 then c.c_mktsegment end as documentation,
       case when c.c_nationkey <> 7 then p.url end as homepage
from customer c
left join (select o_custkey, min(o_orderdate) as first_order from orders group by o_custkey) o
       on o.o_custkey = c.c_custkey
left join {texts} d on d.doc_id = c.c_custkey
left join pages p on p.page_id = cast(floor(c.c_custkey / 6.0) as bigint)"""
        for dialect, description, texts in (
            ("spark", "d.description", "(select doc_id, text, split_part(text, '.', 1) as description from documents)"),
            ("duckdb", "split_part(d.text, '.', 1)", "documents"),
        )
    },
    "crate_downloads": """
select o_custkey as crate_id, count(*) as downloads
from orders where o_orderstatus = 'F' group by o_custkey""",
    "versions": "select o_orderkey as id, o_custkey as crate_id from orders",
    "dependencies": "select l_orderkey as version_id, l_partkey as crate_id from lineitem",
    "docs": """
select doc_id as file_pos,
       concat('docs/', source, '/', cast(doc_id as varchar(20)), '.', lang, '.md') as file_path,
       text
from documents""",
    "useful_docs": "select * from docs where substr(md5(file_path), 1, 1) < 'c'",
    "doc_lines": {
        "spark": """
select file_pos, file_path, cast(topic_pos as bigint) as topic_pos, line
from docs
lateral view posexplode(filter(split(text, '\\n'), x -> length(x) > 0)) t as topic_pos, line""",
        "duckdb": """
select file_pos, file_path,
       generate_subscripts(list_filter(string_split(text, chr(10)), lambda x: length(x) > 0), 1)
         - 1 as topic_pos,
       unnest(list_filter(string_split(text, chr(10)), lambda x: length(x) > 0)) as line
from docs""",
    },
    "topics": """
select file_pos, file_path, topic_pos,
       concat(file_path, ':', cast(topic_pos as varchar(20))) as topic_key,
       split_part(line, '.', 1) as title, line as description
from doc_lines""",
    "judged_topics": """
select *,
       substr(md5(concat('useful:', topic_key)), 1, 1) < 'c' as is_useful,
       case when substr(md5(concat('qa:', topic_key)), 2, 1) = '0' then 4
            when substr(md5(concat('qa:', topic_key)), 2, 1) = '1' then 3
            when substr(md5(concat('qa:', topic_key)), 2, 1) = '2' then 2
            else 1 end as attempts_needed,
       case when substr(md5(concat('n:', topic_key)), 1, 1) < '6' then 1
            when substr(md5(concat('n:', topic_key)), 1, 1) < 'b' then 2
            else 3 end as n_qa
from topics""",
    "qa": {
        dialect: f"""
select t.file_pos, t.topic_pos, t.qa_pos, t.topic_key, t.file_path,
       concat(t.topic_key, ':', cast(t.qa_pos as varchar(20))) as qa_key,
       concat(t.title, ' #', cast(t.qa_pos as varchar(20))) as question,
       case when split_part(t.description, '.', t.qa_pos + 1) = '' then t.description
            else split_part(t.description, '.', t.qa_pos + 1) end as answer
from (select *, {numbers} as qa_pos from judged_topics where is_useful and attempts_needed <= 3) t"""
        for dialect, numbers in (("spark", "explode(sequence(0, n_qa - 1))"), ("duckdb", "unnest(range(0, n_qa))"))
    },
    "qra": """
select *, concat('Because ', answer) as reasoning
from qa where substr(md5(concat('why:', qa_key)), 2, 1) <> '0'""",
    "solve_results": """
select qa_key, question, answer, reasoning,
       concat('Re: ', question) as agent_answer,
       substr(md5(concat('solve:', qa_key)), 1, 1) < 'b' as is_correct
from qra where substr(md5(concat('solve:', qa_key)), 3, 1) <> '0'""",
    "exam_candidates": """
select topic_key, title as topic_title, description as topic_description, file_path,
       concat('Write code for: ', title) as question,
       case when substr(md5(concat('test:', topic_key)), 1, 1) < 'c' then 0 else 101 end as exit_code,
       case when substr(md5(concat('out:', topic_key)), 1, 1) < 'c'
            then concat('ran ', topic_key) end as stdout,
       case when substr(md5(concat('test:', topic_key)), 1, 1) >= 'c'
            then concat('; failed ', title) end as stderr,
       case when substr(md5(concat('sol:', topic_key)), 1, 1) = '0' then null
            else md5(concat('sol:', topic_key)) end as solution_commit,
       case when substr(md5(concat('prob:', topic_key)), 1, 1) = '0' then null
            else md5(concat('prob:', topic_key)) end as problem_commit,
       case when substr(md5(concat('err:', topic_key)), 1, 1) = '0' then 'agent stuck' end as error,
       case when substr(md5(concat('img:', topic_key)), 1, 1) < '5' then null
            when substr(md5(concat('img:', topic_key)), 1, 1) < 'a' then ''
            else concat('image-', substr(md5(concat('img:', topic_key)), 1, 1)) end as image_name
from judged_topics where is_useful""",
    "exam_table": """
select topic_key, topic_title, topic_description, file_path, image_name,
       case when error is not null then '' else 'exam-' end
         || concat(substr(md5(topic_key), 1, 8), '-', substr(md5(topic_key), 9, 4), '-',
                   substr(md5(topic_key), 13, 4), '-', substr(md5(topic_key), 17, 4), '-',
                   substr(md5(topic_key), 21, 12)) as id,
       case when error is not null then '' else question end as question,
       case when error is not null then '' else solution_commit end as solution_commit,
       case when error is not null then '' else problem_commit end as problem_commit,
       case when error is not null then concat('failed: ', error) else 'generated' end as status
from exam_candidates
where error is not null
   or (exit_code = 0 and solution_commit is not null and problem_commit is not null)""",
    "attempts": {
        dialect: f"""
select topic_key, attempt, attempt % 2 = 0 as with_library,
       substr(md5(concat(topic_key, '#', cast(attempt as varchar(20)))), 1, 1) < '8' as success
from (select *, {numbers} as attempt from exam_table where status = 'generated') c"""
        for dialect, numbers in (("spark", "explode(sequence(1, 4))"), ("duckdb", "unnest(range(1, 5))"))
    },
    "conversation_events": """
select conv_id, turn, role,
       case when length(text) < 60 then concat(text, ' [no text content]') else text end as text
from conversations""",
    "raw_responses": """
select topic_key, substr(md5(concat('raw:', topic_key)), 1, 1) as shape,
       case substr(md5(concat('raw:', topic_key)), 1, 1)
            when '0' then 'not json'
            when '1' then '{"is_useful": "yes", "reason": "r"}'
            when '2' then '{"is_useful": true}'
            when '3' then '{"is_useful": true, "reason": 5}'
            when '4' then '{"is_useful": true, "reason": null}'
            when '5' then '{"is_useful": true, "reason": "r", "more": [1]}'
            else '{"is_useful": false, "reason": "r"}' end as response
from topics""",
}


def _text(name: str, dialect: str) -> str:
    sql = VIEWS[name]
    return sql if isinstance(sql, str) else sql[dialect]


def with_views(sql: str, dialect: str) -> str:
    """Put the views a query uses in front of it as common table expressions."""
    needed: set[str] = set()
    waiting = [sql]
    while waiting:
        words = set(re.findall(r"[a-z_]+", waiting.pop()))
        for name in VIEWS:
            if name in words and name not in needed:
                needed.add(name)
                waiting.append(_text(name, dialect))
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} as ({_text(n, dialect)})" for n in VIEWS if n in needed)
    body = sql.strip()
    if re.match(r"with\s", body, re.I):
        return f"with {ctes},\n{body[4:].lstrip()}"
    return f"with {ctes}\n{body}"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def spark_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run SQL over the tables and views in Spark."""
    text = with_views(sql, "spark")
    for name in TABLES:
        if re.search(rf"\b{name}\b", text):
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(text)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark_sql(spark, sf_dir, f"select * from {name}")
