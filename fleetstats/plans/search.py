"""Search, paging and drill-down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstats.functions.text import task_prefix
from fleetstats.operators import ranges, search, text_index
from fleetstats.operators.search import Criterion, compile_criteria
from fleetstats.plans.efficiency import (
    SITE_TABLE_SQL, WORKFLOW_TABLE_SQL, _task_sql, _totals_sql, site_table, task_table, workflow_table,
)
from fleetstats.plans.registry import load, query
from fleetstats.sinks import run_record as run_record_columns
from fleetstats.sinks import write_searchable
from fleetstats.storage import new_path


@query(r"SELECT doc_id, lang, source FROM documents WHERE regexp_matches(text, '(?im)^th[a-z]+ en')")
def search_string_regex(spark, sf_dir):
    found = compile_criteria([Criterion("text", "string", "contains", ["^th[a-z]+ en"])])
    return load(spark, sf_dir, "documents").where(found).select("doc_id", "lang", "source")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_extendedprice >= 20000 AND l_extendedprice <= 50000""")
def search_size(spark, sf_dir):
    found = compile_criteria([
        Criterion("l_extendedprice", "html", "starts", ["20 KB"]),
        Criterion("l_extendedprice", "html", "ends", ["0.05mb"]),
    ])
    return load(spark, sf_dir, "lineitem").where(found).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("""SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS LastAccess FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1997-06-30'""")
def search_date(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    found = orders.where(compile_criteria([
        Criterion("o_orderdate", "date", "between", ["1997-01-01", "1997-06-30"]),
        Criterion("o_orderdate", "date", "!null"),
    ], schema=orders.schema))
    return found.select("o_orderkey", F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("LastAccess"))


@query("SELECT p_partkey, p_size FROM part WHERE (p_size BETWEEN 5 AND 10) OR p_size >= 48 OR p_size IS NULL")
def search_num(spark, sf_dir):
    found = compile_criteria([
        Criterion("p_size", "num", "between", ["5", "1 0"]),
        Criterion("p_size", "num", ">=", ["48"]),
        Criterion("p_size", "num", "null"),
    ], logic="OR")
    return load(spark, sf_dir, "part").where(found).select("p_partkey", "p_size")


_WORDS_SQL = """SELECT doc_id, CASE WHEN lang <> 'de' THEN string_split(text, ' ') END AS words FROM documents"""


@query(f"""WITH d AS ({_WORDS_SQL})
SELECT doc_id, CAST(CASE WHEN words IS NULL THEN 0 ELSE len(words) END AS INT) AS n_words FROM d
WHERE words IS NULL OR len(list_filter(words, lambda w: regexp_matches(w, '(?im)^in'))) = 0""")
def search_array(spark, sf_dir):
    documents = load(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") != "de", F.split("text", " ", -1)).alias("words")
    )
    found = documents.where(compile_criteria([Criterion("words", "array", "!=", ["^in"])]))
    return found.select("doc_id", F.coalesce(F.size("words"), F.lit(0)).alias("n_words"))


@query("SELECT doc_id, quality = 1 AS good FROM labels WHERE quality = 1 AND NOT (toxic = 1)")
def search_boolean(spark, sf_dir):
    flags = load(spark, sf_dir, "labels").select(
        "doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("bad")
    )
    found = flags.where(compile_criteria([
        Criterion("good", "boolean", "true"), Criterion("bad", "boolean", "false")
    ]))
    return found.select("doc_id", "good")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderpriority = '5-LOW'")
def search_enum(spark, sf_dir):
    found = compile_criteria([
        Criterion("o_orderpriority", "wf_type", "1-URGENT"), Criterion("o_orderpriority", "job_type", "5-LOW")
    ], logic="OR")
    return load(spark, sf_dir, "orders").where(found).select("o_orderkey", "o_orderpriority")


@query(f"""{WORKFLOW_TABLE_SQL} SELECT Type, Workflow, WmagentRequestName, CpuEffOutlier, CpuEff, Cpus FROM workflows
WHERE regexp_matches(Workflow, '(?im)^WF_1') AND regexp_matches(Type, '(?im)prod|test') AND Cpus >= 5
  AND CpuTimeHr >= 40000""")
def search_builder(spark, sf_dir):
    found = compile_criteria(
        [
            Criterion("Type", "string", "contains", ["prod|test"]),
            Criterion("Cpus", "num", ">=", ["5"]),
            Criterion("CpuTimeHr", "html", "starts", ["40KB"]),
        ],
        bars={"Workflow": "^WF_1", "WmagentRequestName": ""},
    )
    columns = ["Type", "Workflow", "WmagentRequestName", "CpuEffOutlier", "CpuEff", "Cpus"]
    return workflow_table(spark, sf_dir).where(found).select(*columns)


_KEYS = ["Workflow", "Type", "WmagentRequestName", "CpuEffOutlier"]


def _stored_workflows(spark, sf_dir):
    """The result collection as searches find it: written, sorted by its keys."""
    path = new_path(spark, "workflows")
    write_searchable(workflow_table(spark, sf_dir).select(*_KEYS, "Cpus", "CpuEff"), path, _KEYS)
    return spark.read.parquet(path)


@query(f"""{WORKFLOW_TABLE_SQL}, found AS (SELECT * FROM workflows WHERE regexp_matches(Workflow, '(?im)7$'))
SELECT Type, Workflow, WmagentRequestName, CpuEffOutlier, Cpus, CpuEff,
  (SELECT count(*) FROM found) AS recordsFiltered
FROM found ORDER BY Cpus DESC NULLS LAST, Workflow, Type, WmagentRequestName, CpuEffOutlier LIMIT 25 OFFSET 50""")
def search_page(spark, sf_dir):
    found = compile_criteria([], bars={"Workflow": "7$"})
    table = _stored_workflows(spark, sf_dir)
    page, total = search.search_page(table, found, [("Cpus", "desc"), ("CpuEff", "")], _KEYS, start=50, length=25)
    return page.withColumn("recordsFiltered", total.scalar())


@query(f"""{WORKFLOW_TABLE_SQL} SELECT Type, Workflow, WmagentRequestName, CpuEffOutlier, Cpus, CpuEff FROM workflows
WHERE regexp_matches(Workflow, '(?im)7$') AND (Cpus < 20 OR Cpus IS NULL OR (Cpus = 20 AND (Workflow > 'wf_117'
  OR (Workflow = 'wf_117' AND Type > 'production'))))
ORDER BY Cpus DESC NULLS LAST, Workflow, Type, WmagentRequestName, CpuEffOutlier LIMIT 25""")
def search_page_after(spark, sf_dir):
    """The page behind a row, however deep it is."""
    last = {"Cpus": 20.0, "Workflow": "wf_117", "Type": "production", "WmagentRequestName": "zzz", "CpuEffOutlier": 9}
    found = compile_criteria([], bars={"Workflow": "7$"})
    return search.search_page_after(_stored_workflows(spark, sf_dir), found, [("Cpus", "desc")], _KEYS, last, 25)


@query("""WITH ranked AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus,
  row_number() OVER (ORDER BY o_orderstatus DESC, o_custkey, o_orderkey) - 1 AS position, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, position FROM ranked WHERE position >= n // 2 AND position < n // 2 + 40""")
def search_page_at(spark, sf_dir):
    """A page from the middle of a result, of which three values of the first sort column make up all rows."""
    path = new_path(spark, "ranked")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    ranges.write_ranked(orders, path, [("o_orderstatus", "desc"), ("o_custkey", "asc")], ["o_orderkey"])
    return ranges.page_at(spark, path, ranges.ranked_total(spark, path) // 2, 40)


# With rare trigrams, with alternatives, with a trigram that no text has, and without any.
_PATTERNS = ["licen[sc]e", "all rights (reserved|granted)|Copyright", "^th[a-z]+ en.*MIT", "qzx+", "[0-9]{3}-[0-9]{4}"]


@query(f"""SELECT pattern, doc_id, lang FROM documents, (SELECT unnest({_PATTERNS!r}) AS pattern)
WHERE regexp_matches(text, '(?im)' || pattern) AND lang <> 'fr'""")
def search_text_index(spark, sf_dir):
    """Patterns searched by the trigrams of a stored collection."""
    path = new_path(spark, "indexed")
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    text_index.write_text_index(docs, path, ["doc_id"], ["text"])
    found = [
        text_index.search_text(spark, path, {"text": p}, F.col("lang") != "fr").select(F.lit(p).alias("pattern"), "doc_id", "lang")
        for p in _PATTERNS
    ]
    return reduce(DataFrame.unionByName, found)


@query("""SELECT p_partkey, concat_ws('+', substr(md5('{"q":"' || p_name || '"}'), 1, 8), 'main',
  'and+' || replace(replace(p_name, '/', '_'), ' ', '') || '+Work_flow.contains:ab,c++') AS id FROM part""")
def saved_query_id(spark, sf_dir):
    """Ids of saved requests, one per part name typed in the search bar."""
    tail = search.readable_request([Criterion("Work/flow", "string", "Contains", ["a b", "c"])], "AND")
    bar = F.replace(F.replace(F.col("p_name"), F.lit("/"), F.lit("_")), F.lit(" "), F.lit(""))
    readable = F.concat(F.lit("and+"), bar, F.lit("+"), F.lit(tail.removeprefix("and+")))
    request = F.concat(F.lit('{"q":"'), "p_name", F.lit('"}'))
    return load(spark, sf_dir, "part").select(
        "p_partkey", search.saved_query_id(request, F.lit("main"), readable).alias("id"))


@query(f"""{SITE_TABLE_SQL} SELECT Site, Tier, CpuEff, Cpus, array_to_string(Schedds, ', ') AS Schedds FROM sites
WHERE Type = 'production' AND Workflow = 'wf_17' AND WmagentRequestName = 'req_17' AND CpuEffOutlier = 0""")
def drilldown_workflow(spark, sf_dir):
    rows = search.drilldown(
        site_table(spark, sf_dir), Type="production", Workflow="wf_17", WmagentRequestName="req_17", CpuEffOutlier=0
    )
    return rows.select("Site", "Tier", "CpuEff", "Cpus", search.display(F.col("Schedds")).alias("Schedds"))


@query(f"""WITH found AS ({_task_sql('site')}) SELECT Task, StepName, JobType, Site, CpuEfficiency FROM found
WHERE StepName = 'cmsRun1' AND JobType = 'Merge'""")
def drilldown_task(spark, sf_dir):
    rows = search.drilldown(task_table(spark, sf_dir, "site"), Task="", StepName="cmsRun1", JobType="Merge")
    return rows.select("Task", "StepName", "JobType", "Site", "CpuEfficiency")


@query("""SELECT event_id, user_id, event_type AS kind FROM events
WHERE CAST(json_extract_string(props, '$.k') AS INT) = 42 AND event_type = 'click'
ORDER BY event_id LIMIT 10 OFFSET 2""")
def kv_query(spark, sf_dir):
    payload = F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("event_type").alias("kind"))
    events = load(spark, sf_dir, "events").select(
        "event_id", "user_id", F.struct(payload.alias("payload")).alias("data")
    )
    found = search.key_value_query(events, "k:42, data.payload.kind:click", ["event_id"], start=2)
    return found.select("event_id", "user_id", F.col("data.payload.kind").alias("kind"))


# Placeholders are fixed values; the address is the caller's.
_LINK = "https://grid.example.org/report/[[__TASK_NAME_PREFIX__]]?from=[[__START_DATE_MSEC__]]&day=[[__END_DATE__]]"


@query(f"""{_totals_sql('task')} SELECT Task,
  concat('https://grid.example.org/report/', string_split(Task, '/')[2], '?from=',
    (SELECT CAST(epoch_ms(date_trunc('day', min(o_orderdate))) AS VARCHAR) FROM orders), '&day=',
    (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders)) AS Links FROM totals""")
def link_columns(spark, sf_dir):
    dates = load(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    period = dates.select(*run_record_columns(F.col("first"), F.col("last")))
    tasks = task_table(spark, sf_dir, "task").select(
        "Task",
        period.select("startDate").scalar().alias("startDate"),
        period.select("endDate").scalar().alias("endDate"),
    )
    start = F.col("startDate")
    return search.add_links(tasks, _LINK, {
        "[[__START_DATE__]]": start,
        "[[__END_DATE__]]": F.col("endDate"),
        "[[__TASK_NAME_PREFIX__]]": task_prefix(F.col("Task")),
        "[[__START_DATE_MSEC__]]": F.unix_millis(F.to_timestamp(start)),
    }).select("Task", "Links")


@query("""SELECT strftime(max(l_shipdate), '%Y-%m-%d') AS "createdAt", strftime(min(l_shipdate), '%Y-%m-%d') AS "startDate",
  strftime(max(l_shipdate), '%Y-%m-%d') AS "endDate" FROM lineitem""")
def run_record(spark, sf_dir):
    dates = load(spark, sf_dir, "lineitem").agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    return dates.select(*run_record_columns(F.col("first"), F.col("last")))
