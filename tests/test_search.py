"""Search criteria, pages, drill-down, links."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetstats.functions.sizes import parse_size
from fleetstats.operators import search
from fleetstats.operators.search import Criterion as C
from fleetstats.operators.search import CriterionError, compile_criteria


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [
            (1, "task_a", 10, 5_000, 1_704_067_200, ["T1_X", "T2_Y"], True, "Production"),
            (2, "Task_b\ntask_c", 20, 10_000, 1_706_659_200, ["T2_Z"], False, "Merge"),
            (3, "other", None, 20_000, None, None, None, "Merge"),
        ],
        "id INT, name STRING, n INT, size BIGINT, day BIGINT, sites ARRAY<STRING>, flag BOOLEAN, kind STRING",
    )


@pytest.mark.parametrize(("criterion", "ids"), [
    (C("name", "string", "contains", ["^task_"]), [1, 2]),
    (C("name", "string", "contains", ["C$"]), [2]),
    (C("size", "html", "starts", ["10 kb"]), [2, 3]),
    (C("size", "html", "ends", ["0.01MB"]), [1, 2]),
    (C("day", "date", "<", ["2024-01-01"]), [1]),
    (C("day", "date", ">", ["2024-01-31"]), [2]),
    (C("day", "date", "between", ["2024-01-01", "2024-01-31"]), [1, 2]),
    (C("day", "date", "null"), [3]),
    (C("day", "date", "!null"), [1, 2]),
    (C("n", "num", "<=", ["10"]), [1]),
    (C("n", "num", ">=", ["1 1"]), [2]),
    (C("n", "num", "between", ["10", "20"]), [1, 2]),
    (C("n", "num", "null"), [3]),
    (C("sites", "array", "=", ["t1"]), [1]),
    (C("sites", "array", "!=", ["T1"]), [2, 3]),
    (C("sites", "array", "null"), [3]),
    (C("sites", "array", "!null"), [1, 2]),
    (C("flag", "boolean", "true"), [1]),
    (C("flag", "boolean", "false"), [2]),
    (C("kind", "job_type", "Merge"), [2, 3]),
])
def test_criteria(table, criterion, ids):
    assert sorted(r[0] for r in rows(table.where(compile_criteria([criterion])), "id")) == ids


@pytest.mark.parametrize("criterion", [
    C("size", "html", "ends", ["abc"]), C("size", "html", "starts", ["0"]), C("n", "num", "between", ["1"]),
    C("n", "num", "~", ["1"]), C("name", "string", "=", ["x"]), C("x", "color", "=", ["red"]),
    C("day", "date", "<", ["soon"]),
])
def test_malformed_criteria(table, criterion):
    with pytest.raises(CriterionError):
        compile_criteria([criterion])
    assert table.where(compile_criteria([criterion], lenient=True)).count() == 3


def test_logic_and_bars(table):
    both = [C("n", "num", "<=", ["10"]), C("kind", "wf_type", "Merge")]
    assert table.where(compile_criteria(both, "OR")).count() == 3
    assert table.where(compile_criteria(both, "AND")).count() == 0
    assert table.where(compile_criteria(both, None)).count() == 0
    assert table.where(compile_criteria([], bars={"name": "task", "kind": ""})).count() == 2
    assert table.where(compile_criteria(both[:1], "OR", bars={"name": "other"})).count() == 2


def test_sizes():
    assert [parse_size(t) for t in ("10 TB", "1.5kb", "7", "2 pb")] == [10**13, 1500, 7, 2 * 10**15]


def test_page(table):
    page, total = search.search_page(table, F.lit(True), [("kind", "asc"), ("n", "up")], ["id"], 1, 1)
    assert rows(page, "id") == [(3,)]
    assert rows(total) == [(3,)]
    whole, _ = search.search_page(table, F.lit(True), [("size", "desc")], ["id"], -3, -1)
    assert [r[0] for r in rows(whole, "id")] == [3, 2, 1]


def test_pages_cover_the_matches(spark, sf_dir):
    from fleetstats.plans.registry import load

    orders, found = load(spark, sf_dir, "orders"), F.col("o_totalprice") > 499_000
    pages = [search.search_page(orders, found, [("o_orderdate", "asc")], ["o_orderkey"], s, 7)[0] for s in range(0, 70, 7)]
    seen = [r[0] for p in pages for r in rows(p, "o_orderkey")]
    wanted = [r[0] for r in rows(orders.where(found).orderBy("o_orderdate", "o_orderkey"), "o_orderkey")]
    assert wanted and seen == wanted[: len(seen)] and len(seen) == min(len(wanted), 70)


def test_pages_behind_a_row(spark):
    data = [(i, [None, 1, 2][i % 3], ["a", None][i % 2]) for i in range(30)]
    df = spark.createDataFrame(data, "id INT, n INT, s STRING")
    for order in ([("n", "desc"), ("s", "asc")], [("n", "asc"), ("s", "desc")], []):
        wanted = [r["id"] for r in df.orderBy(*search.order_columns(order, ["id"])).collect()]
        seen, last = [], None
        while page := search.search_page_after(df, F.lit(True), order, ["id"], last, 7).collect():
            seen, last = seen + [r["id"] for r in page], page[-1].asDict()
        assert seen == wanted


def test_oversized_and_unordered_pages_are_refused(table):
    with pytest.raises(ValueError, match="at most"):
        search.search_page(table, F.lit(True), [], ["id"], 0, search.PAGE_CAP + 1)
    with pytest.raises(ValueError, match="order"):
        search.key_value_query(table, "a:1", [])


def test_drilldown_leaves_empty_keys_open(table):
    assert search.drilldown(table, kind="Merge", name="").count() == 2
    assert search.drilldown(table, kind=None).count() == 3


def test_links_and_ids(table):
    linked = search.add_links(table, "u/[[A]]/[[B]]", {"[[A]]": F.col("id"), "[[B]]": F.col("n")})
    assert rows(linked.orderBy("id"), "Links") == [("u/1/10",), ("u/2/20",), ("u/3/",)]
    text = search.readable_request([C("Work/flow", "string", "Contains", ["a b", "c"])], "AND", "wf:x")
    assert text == "and+wf:x+Work_flow.contains:ab,c++"
    made = table.limit(1).select(search.saved_query_id(F.lit("{}"), F.lit("main"), F.lit(text)).alias("x"))
    assert rows(made) == [("99914b93+main+" + text,)]
