"""Log lines."""

from datetime import datetime

import pytest
from helpers import rows

from fleetstats.operators import logs

LINE = (
    '[15/May/2022:23:59:01 +0200] fe1.example.org 192.0.2.7 "GET {request} HTTP/1.1" 200 '
    "[data: 5120 in 20480 out 1024 body 35000 us ] "
    '[auth: TLSv1.2 ECDHE-RSA "/DC=ch/CN=jdoe/CN=123456/CN=Jane Doe" "-" ] [ref: "-" "curl/7.0" ]{port}'
)
REQUEST = "/dbs/prod/global/DBSReader/datasets?dataset=/A/B/C"


def parsed(spark, *lines):
    return logs.parse_access_log(spark.createDataFrame([(v,) for v in lines], "value STRING"))


def test_access_line(spark):
    good, bad = parsed(spark, LINE.format(request=REQUEST, port=" 443"))
    row = good.first().asDict()
    assert bad.count() == 0
    expected = {
        "system": "dbs", "uri_path": "/prod/global/DBSReader/datasets", "uri_params": "?dataset=/A/B/C",
        "api": "datasets", "code": 200, "bytes_sent": 5120, "bytes_received": 20480, "body_size": 1024,
        "time_spent_us": 35000, "dn": "/DC=ch/CN=jdoe/CN=Jane Doe", "fe_port": "443", "tls": "TLSv1.2",
        "crypto": "ECDHE-RSA", "client": "curl/7.0", "frontend": "fe1.example.org", "clientip": "192.0.2.7",
        "method": "GET", "httpversion": "HTTP/1.1", "type": "frontend", "rec_date": datetime(2022, 5, 15, 21, 59, 1),
        "rec_timestamp": 1652651941, "timestamp": 1652651941000,
    }
    assert {k: row[k] for k in expected} == expected
    assert '"' not in row["message"]


def test_no_port(spark):
    good, _ = parsed(spark, LINE.format(request=REQUEST, port=""))
    assert rows(good, "fe_port", "code") == [(None, 200)]


def test_the_time_may_stand_anywhere(spark):
    line = LINE.format(request=REQUEST, port=" 443")
    odd = [
        "host httpd[123]: " + line, "[a] [b c] " + line, line.replace('"curl/7.0"', '"curl "7" x"'),
        line.replace('"-" ] [ref', '"-]" [x] ] [ref'), "[16/May/2022:00:00:00 +0200] cut off " + line,
    ]
    good, bad = parsed(spark, *odd)
    assert bad.count() == 0
    assert rows(good, "rec_timestamp", "client", "fe_port", "dn") == [
        (1652651941, 'curl "7" x' if i == 2 else "curl/7.0", "443", "/DC=ch/CN=jdoe/CN=Jane Doe") for i in range(5)
    ]


@pytest.mark.parametrize(("request_text", "system", "api"), [
    ("/dbs/prod/x", "dbs", "x"), ("/dbs/prod/x/", "dbs", "x"), ("/dbs/x", "dbs", "x"), ("/a-b/c/d/?q=1", "a-b", "d"),
])
def test_api(spark, request_text, system, api):
    good, _ = parsed(spark, LINE.format(request=request_text, port=""))
    assert rows(good, "system", "api") == [(system, api)]


@pytest.mark.parametrize("line", ["", "nonsense", LINE.format(request="/single", port=""),
                                  LINE.format(request="/dbs/x?q=1", port=""), LINE.replace(" us ]", " ms ]")])
def test_rejects(spark, line):
    good, bad = parsed(spark, line)
    assert (good.count(), rows(bad)) == (0, [(line,)])


def test_backend_layouts(spark):
    service = (
        'INFO [15/May/2022:23:59:01] be1 10.0.0.1 "PUT {} HTTP/1.1" 201 OK [data: 1 in 2 out] '
        '[auth: OK "/CN=a/CN=77/CN=b" "" ] [ref: "" "py/3" ]'
    )
    database = "[Sun, 15 May 2022 23:59:01 GMT] [info] [<0.1.2>] 10.1.1.1 - - GET /db/one/two?x=1 200"
    lines = [
        ("dbs", service.format("/dbs/int/global/DBSWriter/files?x=1")), ("dbs", service.format("/other")),
        ("reqmgr2", service.format("/other")), ("couchdb", database), ("couchdb", "text"), ("das", "any text"),
    ]
    good, bad = logs.parse_backend_log(spark.createDataFrame(lines, "tag STRING, value STRING"))
    assert sorted(rows(bad)) == [("couchdb", "text"), ("dbs", lines[1][1])]
    by_type = {r.type: r for r in good.collect()}
    assert sorted(by_type) == ["couchdb", "das", "dbs", "reqmgr2"]
    dbs, couch = by_type["dbs"], by_type["couchdb"]
    assert (dbs.instance, dbs.instance_type, dbs.instance_kind, dbs.api) == ("int", "global", "DBSWriter", "files")
    assert (dbs.code, dbs.status, dbs.dn, dbs.client_agent, dbs.rec_timestamp) == (
        201, "OK", "/CN=a/CN=b", "py/3", 1652659141)
    assert (couch.system, couch.uri_path, couch.uri_params, couch.api) == ("db", "/one/two", "?x=1", "two")
    assert (couch.log_level, couch.code, couch.rec_timestamp) == ("info", 200, 1652659141)


def test_long_bad_lines_and_control_characters(spark):
    """Lines that fit nothing are given up quickly, and the parser's own mark in a line changes nothing."""
    import time

    good = LINE.format(request=REQUEST, port=" 443")
    bad = [good[:-12] + "x" * 16_000, "[" * 16_000, good.split('"')[0] * 200, '[15/May/2022:23:59:01 +0200] ' + '"a ' * 5000,
           "[auth: " * 3000, good.split("[ref")[0] + '[ref: "' + '" "' * 4000, "[15/May/2022:23:59:01 +0200] fe " * 500,
           good[:120] * 130, good.split("[ref")[0] + '] [ref: "" "' * 1300, good.split("[ref")[0] * 70 + '] [ref: "" "' * 300]
    began = time.time()
    records, rejects = parsed(spark, *bad, "\u0001" * 16, good.replace("/A/B", "/A\u0001/B"))
    assert rejects.count() == len(bad) + 1
    assert rows(records, "request", "fe_port") == [(REQUEST, "443")]
    backend = spark.createDataFrame([(t, v) for v in bad for t in ("dbs", "couchdb", "reqmgr2")], "tag STRING, value STRING")
    assert logs.parse_backend_log(backend)[1].count() == 3 * len(bad)
    assert time.time() - began < 30
    began = time.time()
    parsed(spark, *bad * 8)[1].count()
    assert time.time() - began < 8 * len(bad)  # well under a second each
