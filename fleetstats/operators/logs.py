"""Web-service log lines to records; lines that fit no layout are kept as rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstats.functions.numbers import filled
from fleetstats.functions.text import one_line, plain_dn, split_by_pattern

# The layouts of the lines. Each group is one field, named below it.
_WORD, _HOST, _NUM = r"(\w+)", r"([\w.:\-]+)", r"([+-]?\d+(?:\.\d+)?)"

# A record begins at a time in brackets, wherever that stands in the line. From there each field takes only what cannot
# begin the text behind it, so that a line that does not fit is given up soon; only the rest of the authorisation, and the
# client, run up to the brackets that end them, whatever they hold.
ACCESS_LAYOUT = (
    r"(?s)^.*?\[(\d\d/\w+/\d{4}:\d\d:\d\d:\d\d [+-]\d{4})\] (\S*) " + _HOST
    + rf' "{_WORD} (\S+) ([^"]*)" {_NUM} \[data: {_NUM} in {_NUM} out {_NUM} body {_NUM} us \]'
    + r' \[auth: (\S*) (\S*) "([^"]*)".*\] \[ref: "[^"]*" "(.*?)" \](?: ' + _NUM + r")?.*$"
)
ACCESS_FIELDS = [
    "tstamp", "frontend", "clientip", "method", "request", "httpversion", "code", "bytes_sent", "bytes_received",
    "body_size", "time_spent_us", "tls", "crypto", "dn", "client", "fe_port",
]
ACCESS_NUMBERS = ["code", "bytes_sent", "bytes_received", "body_size", "time_spent_us"]

DATABASE_LAYOUT = (
    r"(?s)^.*?\[([^\[\]]*)\] \[" + _WORD + r"\] \[<[^>]*>\] " + _HOST + rf" - - {_WORD} (\S+) {_NUM}.*$"
)
DATABASE_FIELDS = ["tstamp", "log_level", "clientip", "method", "request", "code"]

SERVICE_LAYOUT = (
    r"(?s)^.*\[([^\[\]\s]+)\] (\S*) " + _HOST + rf' "{_WORD} (\S+) ([^"]*)" {_NUM} {_WORD} \[data:[^\]]*\]'
    + rf' \[auth: {_WORD} "([^"]*)" "[^"]*" \] \[ref: "[^"]*" "(.*?)" \].*$'
)
SERVICE_FIELDS = [
    "tstamp", "backend", "clientip", "method", "request", "httpversion", "code", "status", "auth", "dn",
    "client_agent",
]

# Which tag uses which layout.
BACKEND_LAYOUTS = {"couchdb": "database", "dbs": "service", "reqmgr2": "service"}

_PATH, _PARAMS = r"((?:/[\w%!$@:.,+~\-]*)+)", r"(\?[A-Za-z0-9$.+!*'|(){},~@#%&/=:;_?\-\[\]<>]*)?"
REQUEST_LAYOUT = rf"(?s)^.*?/\b([\w\-]+)\b{_PATH}{_PARAMS}.*$"
INSTANCE_LAYOUT = r"(?s)^.*?/dbs/(\w+)/(\w+)/(\w+)/(\w*).*$"


def _fields(df: DataFrame, line: Column, layout: str, names: list[str]) -> DataFrame:
    """One column per group, all null where the line does not fit.

    The match goes through a one-element explode: a filter on its fields then stays above it,
    and the pattern is evaluated once per line instead of once per use.
    """
    parts = split_by_pattern(line, layout, len(names))
    fits = F.coalesce(F.size("_parts") == len(names) + 1, F.lit(False))
    fields = [F.when(fits, filled(F.get("_parts", F.lit(i + 1)))).alias(name) for i, name in enumerate(names)]
    return df.withColumn("_parts", F.explode(F.array(parts))).select("*", *fields, fits.alias("_fits")).drop("_parts")


def _times(df: DataFrame, text: Column, fmt: str) -> DataFrame:
    return df.withColumn("rec_date", F.try_to_timestamp(text, F.lit(fmt))).withColumns({
        "rec_timestamp": F.unix_seconds("rec_date"),
        "timestamp": F.unix_millis("rec_date"),
    })


def parse_request(df: DataFrame, request: str = "request") -> DataFrame:
    """System, path, parameters and API of a request.

    The API is the last element of the path, or the one before if the path ends with a slash.
    Where there is none, ``api_found`` is false and both system and API are the request itself.
    """
    split = _fields(df, F.col(request), REQUEST_LAYOUT, ["system", "uri_path", "uri_params"])
    # without parameters the API is looked for in the whole request
    source = F.when(F.col("uri_params").isNotNull(), F.col("uri_path")).otherwise(F.col(request))
    last = filled(F.regexp_extract(source, r"/.*/(.*)$", 1))
    before = filled(F.regexp_extract(source, r"/.*/(.*)/$", 1))
    found = F.col("_found")
    return split.withColumn("_found", F.when(F.col("_fits"), F.coalesce(last, before))).withColumns({
        "api": F.coalesce(found, F.col(request)),
        "system": F.when(found.isNull(), F.col(request)).otherwise(F.col("system")),
        "api_found": found.isNotNull(),
    }).drop("_fits", "_found")


def mark_access_log(df: DataFrame, line: str = "value") -> DataFrame:
    """Front-end access lines with the fields of their record and ``is_record``, in one pass over the lines."""
    fields = _fields(df, F.col(line), ACCESS_LAYOUT, ACCESS_FIELDS).withColumnRenamed("_fits", "_line_fits")
    return _times(parse_request(fields), F.col("tstamp"), "dd/MMM/yyyy:HH:mm:ss Z").withColumns({
        **{name: F.col(name).try_cast("long") for name in ACCESS_NUMBERS},
        "dn": plain_dn(F.col("dn")),
        "message": one_line(F.col(line)),
        "type": F.lit("frontend"),
        "is_record": F.col("_line_fits") & F.col("api_found"),
    }).drop("_line_fits", "api_found")


def parse_access_log(df: DataFrame, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """Records of front-end access lines, and the lines that are none.

    To write both, write the marked lines once, partitioned by ``is_record`` (``mark_access_log``).
    """
    marked = mark_access_log(df, line)
    records = marked.where("is_record").drop("is_record", line)
    return records, marked.where(~F.col("is_record")).select(*df.columns)


def _service_lines(df: DataFrame, line: str) -> DataFrame:
    parsed = _fields(df, F.col(line), SERVICE_LAYOUT, SERVICE_FIELDS)
    parsed = _times(parsed, F.col("tstamp"), "dd/MMM/yyyy:HH:mm:ss").withColumn("dn", plain_dn(F.col("dn")))
    names = ["instance", "instance_type", "instance_kind", "api"]
    return _fields(parsed.withColumnRenamed("_fits", "_line_fits"), F.col("request"), INSTANCE_LAYOUT, names).withColumn(
        "_ok", F.col("_line_fits") & (F.col("_fits") | (F.col("type") != "dbs"))
    ).drop("_fits", "_line_fits")


def _database_lines(df: DataFrame, line: str) -> DataFrame:
    parsed = _fields(df, F.col(line), DATABASE_LAYOUT, DATABASE_FIELDS)
    # the parser refuses week-day names, and needs none
    parsed = _times(parsed, F.regexp_replace("tstamp", r"^\w+, ", ""), "dd MMM yyyy HH:mm:ss z")
    parsed = parsed.withColumnRenamed("_fits", "_line_fits")
    split = _fields(parsed, F.col("request"), REQUEST_LAYOUT, ["system", "uri_path", "uri_params"])
    return split.withColumn("api", filled(F.regexp_extract("uri_path", r"/.*/(.*)$", 1))).withColumn(
        "_ok", F.col("_line_fits") & F.col("_fits") & F.col("uri_path").rlike(r"/.*/.*$")
    ).drop("_fits", "_line_fits")


def parse_backend_log(df: DataFrame, line: str = "value", tag: str = "tag") -> tuple[DataFrame, DataFrame]:
    """Records of tagged backend lines, each tag with its own layout, and the lines that do not fit.

    Lines of a tag without a layout pass with their type alone.
    """
    typed = df.withColumn("type", F.col(tag))
    tags = {kind: [t for t, k in BACKEND_LAYOUTS.items() if k == kind] for kind in ("database", "service")}
    known = [t for names in tags.values() for t in names]
    parsed = (
        _service_lines(typed.where(F.col(tag).isin(*tags["service"])), line)
        .unionByName(_database_lines(typed.where(F.col(tag).isin(*tags["database"])), line), allowMissingColumns=True)
        .unionByName(typed.where(~F.col(tag).isin(*known)).withColumn("_ok", F.lit(True)), allowMissingColumns=True)
        .withColumn("code", F.col("code").try_cast("long"))
    )
    good = parsed.where("_ok").withColumn("message", one_line(F.col(line))).drop("_ok", line)
    return good, parsed.where(~F.col("_ok")).select(*df.columns)
