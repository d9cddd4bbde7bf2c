"""Scans, dumps, extracts and star joins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fleetstats import sinks
from fleetstats.functions.times import epoch_seconds
from fleetstats.operators import catalogue as cat
from fleetstats.plans import views
from fleetstats.plans.registry import load, query
from fleetstats.plans.views import _WORK_COLUMNS, JOBS_SQL
from fleetstats.schemas import JOB_ARCHIVE, JOB_FIELDS, WORK_FIELDS
from fleetstats.sources import archive, files, manifest, typed
from fleetstats.sources import catalogue as dumps
from fleetstats.storage import new_path

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


# ---- archives -------------------------------------------------------------------------------


def _month(col):
    return F.trunc(col, "MM")


def _job_archive(spark, sf_dir):
    """All jobs as JSON lines, one folder per month."""
    path = new_path(spark, "jobs")

    def shape(lines):
        return views.job_records(lines, "dt").select(F.struct(*JOB_FIELDS.names).alias("data"), "dt")

    archive.write_archive(views.order_lines(spark, sf_dir, None, None), path, _month("l_shipdate"), shape=shape)
    return path


@query(f"""WITH jobs AS ({JOBS_SQL}) SELECT GlobalJobId, RecordTime, Workflow, WMAgent_RequestName, Tier, CpuTimeHr,
  RequestCpus, CpuEffOutlier FROM jobs""")
def scan_jobs(spark, sf_dir):
    fields = [
        "GlobalJobId", "RecordTime", "Workflow", "WMAgent_RequestName", "Tier", "CpuTimeHr", "RequestCpus",
        "CpuEffOutlier",
    ]
    return archive.read_jobs(spark, _job_archive(spark, sf_dir), fields=fields)


@query(f"""WITH jobs AS ({JOBS_SQL}) SELECT Status, count(*) AS n, min(RecordTime) AS first, max(RecordTime) AS last
FROM jobs WHERE RecordTime >= epoch_ms(TIMESTAMP '1997-03-01') AND RecordTime < epoch_ms(TIMESTAMP '1997-06-01')
GROUP BY Status""")
def partition_pruned_scan(spark, sf_dir):
    path = _job_archive(spark, sf_dir)
    jobs = archive.read_jobs(spark, path, "1997-03-01", "1997-05-30", ["Status", "RecordTime"])
    return jobs.groupBy("Status").agg(
        F.count("*").alias("n"), F.min("RecordTime").alias("first"), F.max("RecordTime").alias("last")
    )


@query(f"""WITH jobs AS ({JOBS_SQL}) SELECT Status, count(*) AS n, min(RecordTime) AS first, max(RecordTime) AS last,
  true AS fewer_files FROM jobs
WHERE RecordTime >= epoch_ms(TIMESTAMP '1997-03-10') AND RecordTime < epoch_ms(TIMESTAMP '1997-05-20') GROUP BY Status""")
def manifest_scan(spark, sf_dir):
    """A period read from the files whose record times overlap it."""
    path, listed = _job_archive(spark, sf_dir), new_path(spark, "manifest")

    def read(files):
        return archive.read_archive(spark, files, JOB_ARCHIVE, fields=["Status", "RecordTime"])

    time = F.col("data.RecordTime")
    manifest.write_manifest(read([path]), time, listed)
    start, end = (1000 * epoch_seconds(t) for t in ("1997-03-10", "1997-05-20"))
    jobs = manifest.manifest_scan(spark, listed, read, read([path]).schema, time, start, end).select("data.*")
    fewer = len(manifest.overlapping_files(spark, listed, start, end)) < manifest.read_manifest(spark, listed).count()
    return jobs.groupBy("Status").agg(
        F.count("*").alias("n"), F.min("RecordTime").alias("first"), F.max("RecordTime").alias("last")
    ).withColumn("fewer_files", F.lit(fewer))


@query(f"""SELECT {_WORK_COLUMNS['fwjr_id']} AS fwjr_id, {_WORK_COLUMNS['task']} AS task,
  CAST(epoch(l_shipdate) AS BIGINT) AS timestamp, 5 AS n_steps, {_WORK_COLUMNS['era']} AS era FROM lineitem""")
def scan_steps(spark, sf_dir):
    path = new_path(spark, "work")

    def shape(lines):
        metadata = F.struct(F.col("wmats").alias("timestamp")).alias("metadata")
        return views.work_records(lines, "dt").select(F.struct(*WORK_FIELDS.names).alias("data"), metadata, "dt")

    archive.write_archive(views.order_lines(spark, sf_dir, None, None), path, _month("l_shipdate"), shape=shape)
    return archive.read_work(spark, path, fields=["task", "meta_data.fwjr_id", "steps.output.acquisitionEra"]).select(
        "meta_data.fwjr_id", "task", "timestamp", F.size("steps").alias("n_steps"),
        F.col("steps")[0]["output"][0]["acquisitionEra"].alias("era"),
    )


@query("""SELECT CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events ORDER BY k LIMIT 10""")
def json_path_limit(spark, sf_dir):
    records = load(spark, sf_dir, "events").select(F.from_json("props", "k INT").alias("data"))
    return archive.nested_values(records.orderBy("data.k"), "data.k", 10)


@query(" UNION ALL ".join(f"SELECT '{t}.parquet' AS name, count(*) AS n_rows, true AS has_bytes FROM {t}" for t in TABLES))
def file_inventory(spark, sf_dir):
    """The files of each table with their rows; sizes are only checked to be there, SQL does not see them."""
    tables = {t: load(spark, sf_dir, t) for t in TABLES}
    listed = files.table_files(tables).groupBy("name").agg(
        F.sum("n_rows").alias("n_rows"), (F.min("size") > 0).alias("has_bytes"))
    return listed.withColumn("name", F.concat("name", F.lit(".parquet")))


@query("""SELECT n_nationkey, n_name FROM nation""")
def json_object_or_list(spark, sf_dir):
    """Files of one JSON object each, and a file with a list of them, read alike."""
    path, nation = new_path(spark, "objects"), load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    record = F.struct("n_nationkey", "n_name")
    single = nation.where("n_nationkey < 5").select(F.col("n_nationkey").alias("file"), F.to_json(record).alias("value"))
    single.write.partitionBy("file").text(f"{path}/one")
    listed = nation.where("n_nationkey >= 5").agg(F.to_json(F.collect_list(record)).alias("value"))
    listed.write.text(f"{path}/many")
    one, many = (archive.read_one_or_many(spark, f"{path}/{kind}", nation.schema) for kind in ("one", "many"))
    return one.select("n_nationkey", "n_name").unionByName(many)


# ---- sinks ----------------------------------------------------------------------------------


@query("""SELECT c_custkey, concat(c_name, ', "', c_mktsegment, '" \\ ') AS label, c_acctbal FROM customer""")
def csv_roundtrip(spark, sf_dir):
    label = F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('" \\ '))
    table = load(spark, sf_dir, "customer").select("c_custkey", label.alias("label"), "c_acctbal")
    path = new_path(spark, "csv")
    dumps.write_csv_dump(table, path)
    return dumps.read_csv_dump(spark, path, table.schema)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
  CASE WHEN c_custkey % 50 <> 0 AND c_custkey % 70 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) END AS balance,
  CASE WHEN c_custkey % 70 <> 0 AND c_custkey % 50 <> 0 THEN c_nationkey END AS c_nationkey,
  concat_ws(',', CASE WHEN c_custkey % 50 = 0 THEN 'c_acctbal=n/a' END, CASE WHEN c_custkey % 70 = 0 THEN 'c_nationkey=1x' END) AS bad FROM customer""")
def typed_dump(spark, sf_dir):
    """A dump read with types of its own for some columns; rows with a value that has not its type come apart."""
    customer = load(spark, sf_dir, "customer")
    texts = customer.select(
        "c_custkey", "c_name", F.when(F.col("c_custkey") % 50 == 0, "n/a").otherwise(F.format_string("%.2f", "c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 70 == 0, "1x").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
    )
    path = new_path(spark, "typed")
    dumps.write_csv_dump(texts, path)
    table = customer.select("c_custkey", "c_name", "c_acctbal", "c_nationkey").schema
    good, rejects = typed.read_typed_dump(spark, path, table, {"C_CUSTKEY": "string", "c_acctbal": "decimal(12,2)"})
    text = F.col("c_acctbal").cast("string").alias("balance")
    listed = F.transform("bad_columns", lambda c: F.concat(c, F.lit("="), F.element_at("raw_values", c)))
    nothing = F.lit(None)
    return good.select("c_custkey", "c_name", text, "c_nationkey", F.lit("").alias("bad")).unionByName(rejects.select(
        "c_custkey", "c_name", nothing.cast("string").alias("balance"), nothing.cast(table["c_nationkey"].dataType).alias("c_nationkey"),
        F.array_join(listed, ",").alias("bad"),
    ))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority FROM orders")
def write_json_roundtrip(spark, sf_dir):
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    table = load(spark, sf_dir, "orders").select("o_orderkey", priority.alias("priority"))
    path = new_path(spark, "json")
    table.write.mode("overwrite").json(path)
    return spark.read.schema(table.schema).json(path)


@query("""SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS dt FROM orders""")
def append_partition(spark, sf_dir):
    """Two extracts that overlap by a month; the second replaces the months it brings."""
    path = new_path(spark, "merged")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM").alias("dt"),
    )
    for start, end in ((date(1900, 1, 1), date(1998, 7, 1)), (date(1998, 6, 1), date(2100, 1, 1))):
        extract = orders.where((F.col("day") >= F.lit(start)) & (F.col("day") < F.lit(end)))
        sinks.append_extract(extract, path, "dt", "day", start, end)
    return spark.read.schema(orders.schema).parquet(path).drop("day")


@query("""SELECT o_orderkey, o_totalprice, '1997-01-01' AS taken FROM orders WHERE year(o_orderdate) = 1997""")
def latest_snapshot(spark, sf_dir):
    """Dumps of three years; the last one does not pass its check, so the one before is current."""
    path = new_path(spark, "snapshots")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    for year, least in ((1996, 1), (1997, 1), (1998, 1 << 62)):
        dump = orders.where(F.year("o_orderdate") == year).drop("o_orderdate")
        try:
            sinks.write_snapshot(dump, path, f"{year}-01-01", least, "taken")
        except ValueError:
            if least == 1:
                raise
    current = cat.latest_snapshot(spark.read.parquet(path), spark.read.parquet(sinks.snapshot_marks(path)), "taken")
    return current.withColumn("taken", F.col("taken").cast("string"))


@query("""WITH partitions AS (SELECT DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN 'replicas'
    WHEN '2-HIGH' THEN 'catalogue' WHEN '3-MEDIUM' THEN 'lumis' ELSE 'other' END AS family,
  CAST(o_orderdate AS DATE) AS dt FROM orders)
SELECT family, CAST(dt AS VARCHAR) AS dt FROM partitions WHERE (family = 'replicas' AND dt < DATE '2001-08-01' - 540)
  OR (family = 'catalogue' AND dt < DATE '2001-08-01' - 180) OR (family = 'lumis' AND dt < DATE '2001-08-01' - 30)""")
def expired_partitions(spark, sf_dir):
    priority = F.col("o_orderpriority")
    family = (
        F.when(priority == "1-URGENT", "replicas").when(priority == "2-HIGH", "catalogue")
        .when(priority == "3-MEDIUM", "lumis").otherwise("other")
    )
    partitions = load(spark, sf_dir, "orders").select(
        family.alias("family"), F.col("o_orderdate").cast("date").alias("dt")
    ).distinct()
    expired = cat.expired_partitions(partitions, {"replicas": 540, "catalogue": 180, "lumis": 30}, "2001-08-01")
    return expired.select("family", F.col("dt").cast("string").alias("dt"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n FROM {t}" for t in TABLES))
def table_row_counts(spark, sf_dir):
    return cat.table_row_counts({t: load(spark, sf_dir, t) for t in TABLES})


# ---- extracts -------------------------------------------------------------------------------

_BLOCKS_SQL = """SELECT o_orderkey AS block_id, CAST(epoch(o_orderdate) AS BIGINT) AS creation_date,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(epoch(o_orderdate) AS BIGINT) + o_custkey * 3600 END
    AS last_modification_date FROM orders"""


def _blocks(spark, sf_dir, before):
    """Blocks created before a time, which the scan sees as a range of the stored date."""
    created = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    orders = load(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))
    return orders.select(
        F.col("o_orderkey").alias("block_id"),
        created.alias("creation_date"),
        F.when(F.col("o_orderpriority") != "5-LOW", created + F.col("o_custkey") * 3600)
        .alias("last_modification_date"),
    )


@query(f"""WITH b AS ({_BLOCKS_SQL}) SELECT * FROM b WHERE
  (creation_date >= epoch(TIMESTAMP '1997-04-01') OR last_modification_date >= epoch(TIMESTAMP '1997-04-01'))
  AND creation_date < epoch(TIMESTAMP '1997-06-01') AND last_modification_date < epoch(TIMESTAMP '1997-06-01')""")
def incremental_extract(spark, sf_dir):
    blocks = _blocks(spark, sf_dir, "1997-06-01")
    return cat.changed_between(blocks, epoch_seconds("1997-04-01"), epoch_seconds("1997-06-01"))


@query(f"""WITH b AS ({_BLOCKS_SQL}) SELECT * FROM b
WHERE creation_date < epoch(TIMESTAMP '1998-01-01') AND last_modification_date < epoch(TIMESTAMP '1998-01-01')""")
def snapshot_as_of(spark, sf_dir):
    return cat.snapshot_as_of(
        _blocks(spark, sf_dir, "1998-01-01"), epoch_seconds("1998-01-01"), modified="last_modification_date"
    )


@query("""SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-02-01' AND l_shipdate < TIMESTAMP '1997-08-15 12:00:00'""")
def history_extract(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return cat.range_extract(lines, "l_shipdate", "97-02-01 00:00:00", "97-08-15 12:00:00")


@query("""WITH f AS (SELECT l_orderkey, l_partkey, l_linenumber, epoch(l_shipdate) AS c,
    CASE WHEN l_linenumber < 7 THEN epoch(l_shipdate) + l_quantity * 86400 END AS m FROM lineitem)
SELECT concat('/store/', l_orderkey, '/', l_linenumber) AS logical_file_name, o_orderpriority AS block_name,
  p_name AS dataset, CAST(c AS BIGINT) AS file_creation_date, CAST(m AS BIGINT) AS file_modification_date
FROM f JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE (c >= epoch(TIMESTAMP '1998-03-01') AND c < epoch(TIMESTAMP '1998-04-01'))
  OR (m >= epoch(TIMESTAMP '1998-03-01') AND m < epoch(TIMESTAMP '1998-04-01'))""")
def changed_files_join(spark, sf_dir):
    created = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    changed = F.when(F.col("l_linenumber") < 7, created + (F.col("l_quantity") * 86400).cast("long"))
    # nothing is changed before it is created
    until = load(spark, sf_dir, "lineitem").where(F.col("l_shipdate") < F.lit("1998-04-01").cast("timestamp_ntz"))
    lines = until.select(
        F.concat(F.lit("/store/"), "l_orderkey", F.lit("/"), "l_linenumber").alias("logical_file_name"),
        F.col("l_orderkey").alias("block_id"), F.col("l_partkey").alias("dataset_id"),
        created.alias("file_creation_date"), changed.alias("file_modification_date"),
    )
    blocks = load(spark, sf_dir, "orders").selectExpr("o_orderkey AS block_id", "o_orderpriority AS block_name")
    datasets = load(spark, sf_dir, "part").selectExpr("p_partkey AS dataset_id", "p_name AS dataset")
    joined = cat.changed_files(lines, blocks, datasets, epoch_seconds("1998-03-01"), epoch_seconds("1998-04-01"))
    return joined.drop("block_id", "dataset_id")


# ---- star joins -----------------------------------------------------------------------------


def _dimension(df, key: str, name: str, key_as: str, name_as: str):
    return df.select(F.col(key).cast("long").alias(key_as), F.col(name).alias(name_as))


def _small_dimensions(spark, sf_dir):
    region, nation = load(spark, sf_dir, "region"), load(spark, sf_dir, "nation")
    return {
        "input_collection": _dimension(region, "r_regionkey", "r_name", "InputCollectionId", "InputCollection"),
        "application": _dimension(nation, "n_nationkey", "n_name", "ApplicationId", "Application"),
        "task_type": _dimension(region, "r_regionkey", "r_name", "TaskTypeId", "Type"),
        "submission_tool": _dimension(nation, "n_nationkey", "n_name", "SubmissionToolId", "SubmissionTool"),
        "scheduler": _dimension(nation, "n_nationkey", "n_name", "SchedulerId", "SchedulerName"),
    }


@query("""SELECT o_orderkey AS "JobId", concat('file_', l_linenumber) AS "FileName", l_discount > 0.05 AS "IsParentFile",
  l_linestatus = 'F' AS "SuccessFlag", l_returnflag AS "FileType", s.s_suppkey AS "BlockId", s.s_name AS "BlockName",
  ic.r_name AS "InputCollection", app.n_name AS "Application", tt.r_name AS "Type", st.n_name AS "SubmissionTool",
  si.n_name AS "SiteName", sch.n_name AS "SchedulerName", c_custkey AS "TaskId", CAST(c_nationkey AS BIGINT) AS "UserId",
  us.n_name AS "GridName", o_orderdate AS "FinishedTimeStamp"
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
JOIN supplier s ON s.s_suppkey = o_custkey // 16 JOIN region ic ON ic.r_regionkey = c_nationkey // 5
JOIN nation app ON app.n_nationkey = c_nationkey JOIN region tt ON tt.r_regionkey = c_nationkey // 6
JOIN nation st ON st.n_nationkey = c_nationkey JOIN nation si ON si.n_nationkey = length(o_orderpriority)
JOIN nation sch ON sch.n_nationkey = CAST(substr(o_orderpriority, 1, 1) AS INT) JOIN nation us ON us.n_nationkey = c_nationkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def popularity_star(spark, sf_dir):
    orders, lines = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    customer, nation = load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation")
    tables = _small_dimensions(spark, sf_dir) | {
        "job": orders.selectExpr(
            "o_orderkey AS JobId", "o_custkey AS TaskId", "o_orderdate AS FinishedTimeStamp",
            "CAST(length(o_orderpriority) AS BIGINT) AS SiteId",
            "CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS SchedulerId",
        ),
        "job_file": lines.selectExpr(
            "l_orderkey AS JobId", "concat('file_', l_linenumber) AS FileName", "l_discount > 0.05 AS IsParentFile",
            "l_linestatus = 'F' AS SuccessFlag", "l_returnflag AS FileType",
        ),
        "job_block": orders.selectExpr("o_orderkey AS JobId", "o_custkey div 16 AS BlockId"),
        "task": customer.selectExpr(
            "c_custkey AS TaskId", "CAST(c_nationkey AS BIGINT) AS UserId", "CAST(c_nationkey div 5 AS BIGINT) AS InputCollectionId",
            "CAST(c_nationkey AS BIGINT) AS ApplicationId", "CAST(c_nationkey div 6 AS BIGINT) AS TaskTypeId",
            "CAST(c_nationkey AS BIGINT) AS SubmissionToolId",
        ),
        "data_block": load(spark, sf_dir, "supplier").selectExpr("s_suppkey AS BlockId", "s_name AS BlockName"),
        "site": _dimension(nation, "n_nationkey", "n_name", "SiteId", "SiteName"),
        "users": _dimension(nation, "n_nationkey", "n_name", "UserId", "GridName"),
    }
    return cat.popularity_star(tables, "96-01-01 00:00:00", "99-01-01 00:00:00")


@query("""WITH job AS (SELECT *, l_shipdate + to_hours(CAST(l_quantity AS INT)) AS finished,
    CASE WHEN l_returnflag = 'N' THEN 'F' WHEN l_discount < 0.005 THEN 'X' ELSE 'S' END AS job_end,
    CASE WHEN l_linenumber = 3 THEN 'F' WHEN l_linestatus = 'F' THEN 'D' ELSE 'U' END AS grid_end FROM lineitem)
SELECT l_orderkey * 10 + l_linenumber AS "JobId", o_orderkey AS "TaskId",
  CASE WHEN job_end = 'S' AND grid_end IN ('D', 'U') THEN 'success' ELSE 'failed' END AS state,
  CAST(epoch(finished) - epoch(l_shipdate) AS BIGINT) AS duration, p_name AS "NodeName", tt.r_name AS "Type",
  c_name AS "GridName", s_name AS "SiteName", ic.r_name AS "InputCollection", app.n_name AS "Application",
  st.n_name AS "SubmissionTool", sch.n_name AS "SchedulerName"
FROM job JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
JOIN region tt ON tt.r_regionkey + 1 = CAST(substr(o_orderpriority, 1, 1) AS INT) JOIN customer ON c_custkey = o_custkey
JOIN supplier ON s_suppkey = l_suppkey JOIN region ic ON ic.r_regionkey + 1 = CAST(substr(o_orderpriority, 1, 1) AS INT)
JOIN nation app ON app.n_nationkey = length(o_orderpriority) JOIN nation st ON st.n_nationkey = length(o_orderpriority)
JOIN nation sch ON sch.n_nationkey = l_linenumber
WHERE l_tax < 0.065 AND job_end IN ('S', 'F') AND NOT l_quantity = 50
  AND finished >= TIMESTAMP '1997-07-04' AND finished < TIMESTAMP '1998-07-05'""")
def dashboard_star(spark, sf_dir):
    # jobs run for up to 50 hours, so those finished in the period started from two days and two hours before
    lines = load(spark, sf_dir, "lineitem").where(
        "l_shipdate >= TIMESTAMP_NTZ '1997-07-01 22:00:00' AND l_shipdate < TIMESTAMP_NTZ '1998-07-05'")
    tables = _small_dimensions(spark, sf_dir) | {
        "job": lines.selectExpr(
            "l_orderkey * 10 + l_linenumber AS JobId", "l_orderkey AS TaskId", "l_suppkey AS SiteId",
            "CAST(l_linenumber AS BIGINT) AS SchedulerId", "l_partkey AS WNIp",
            "l_shipdate AS StartedRunningTimeStamp",
            "l_shipdate + make_dt_interval(0, CAST(l_quantity AS INT)) AS FinishedTimeStamp",
            "CASE WHEN l_returnflag = 'N' THEN 'F' WHEN l_discount < 0.005 THEN 'X' ELSE 'S' END AS DboardJobEndId",
            "CASE WHEN l_linenumber = 3 THEN 'F' WHEN l_linestatus = 'F' THEN 'D' ELSE 'U' END AS DboardGridEndId",
            "CASE WHEN l_tax < 0.065 THEN 'T' ELSE 'R' END AS DboardStatusId",
            "CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END AS TimeOutFlag",
        ),
        "task": load(spark, sf_dir, "orders").selectExpr(
            "o_orderkey AS TaskId", "o_custkey AS UserId", "CAST(substr(o_orderpriority, 1, 1) AS BIGINT) - 1 AS TaskTypeId",
            "CAST(substr(o_orderpriority, 1, 1) AS BIGINT) - 1 AS InputCollectionId",
            "CAST(length(o_orderpriority) AS BIGINT) AS ApplicationId",
            "CAST(length(o_orderpriority) AS BIGINT) AS SubmissionToolId",
        ),
        "node": load(spark, sf_dir, "part").selectExpr("p_partkey AS NodeId", "p_name AS NodeName"),
        "users": load(spark, sf_dir, "customer").selectExpr("c_custkey AS UserId", "c_name AS GridName"),
        "site": load(spark, sf_dir, "supplier").selectExpr("s_suppkey AS SiteId", "s_name AS SiteName"),
    }
    return cat.dashboard_star(tables, "97-07-04 00:00:00", "98-07-05 00:00:00")
