import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from searchshift.functions.predicates import date_range, match_text, query_tokens, range_filter
from searchshift.operators import reconcile, search

TEXTS = ["Airport transfer from Midtown.", "airports are busy", "the AIRPORT!", "", None, "été à l'aéroport",
         "x-airport-y", "airport2", "one two three", "Two, three"]


def hits(spark, query, operator="or"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    return {r["i"] for r in df.filter(match_text(F.col("t"), query, operator)).collect()}


def brute(query, operator="or"):
    wanted = query_tokens(query)
    found = set()
    for i, t in enumerate(TEXTS):
        tokens = set(re.findall(r"[^\W_]+", (t or "").lower()))
        test = [w in tokens for w in wanted]
        if test and (any(test) if operator == "or" else all(test)):
            found.add(i)
    return found


@pytest.mark.parametrize("query", ["airport", "AirPort", "two three", "Été", "three airport", "", "...", "l", "zebra"])
@pytest.mark.parametrize("operator", ["or", "and"])
def test_match(spark, query, operator):
    assert hits(spark, query, operator) == brute(query, operator)


def test_match_operator_is_checked(spark):
    with pytest.raises(ValueError):
        match_text(F.col("t"), "x", "xor")


def test_field_predicates(spark):
    df = spark.createDataFrame([("CMT",), ("cmt x",), ("VTS",)], "v string")

    def count(value, target, predicate):
        return df.filter(search.field_predicate(F.col("v"), value, target, predicate)).count()

    assert count("CMT", "text", "match") == 2 and count("CMT", "text", "term") == 0
    assert count("cmt", "text", "term") == 2 and count("CMT", "keyword", "term") == 1
    assert count("cmt", "keyword", "term") == 0


def test_field_query(spark):
    df = spark.createDataFrame([("a b", "K", 1), ("b", "k", 2)], "t string, k string, n int")
    types = {"t": "text", "k": "keyword", "n": "integer"}
    counts = [search.field_query(df, q, types).count()
              for q in ("*:*", "t:B", "t:a", "k:k", "n:2", "n:x", "other:1")]
    assert counts == [2, 2, 1, 1, 1, 0, 0]


def test_ranges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    assert df.filter(range_filter(F.col("x"), gte=3.0, lt=5.0)).count() == 2
    assert df.filter(range_filter(F.col("x"), gt=3.0, lte=5.0)).count() == 2
    assert df.filter(range_filter(F.col("x"))).count() == 10


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_day_bounds(spark, kind):
    stamps = ["2024-05-31 23:59:59", "2024-06-01 00:00:00", "2024-06-30 23:59:59.999999", "2024-07-01 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast(kind).alias("d"))
    assert df.filter(date_range(df, "d", gte="2024-06-01", lte="2024-06-30")).count() == 2
    assert df.filter(date_range(df, "d", gt="2024-05-31", lt="2024-07-01")).count() == 2


def test_metrics_ignore_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 4.0)], "a int, b double")
    got = search.metric_aggs(df, {"m": ("avg", "a"), "s": ("sum", "b"), "n": ("count", "a")}).first()
    assert tuple(got) == (1.0, 6.0, 1)


def test_small_reports(spark, rows):
    copies = spark.createDataFrame([(1, "p", 5), (0, "r", 2), (0, "p", 2), (0, "r", 3)], "shard int, prirep string, docs bigint")
    assert [tuple(r) for r in search.docs_per_shard(copies).collect()] == [(0, "p", 2, 1), (0, "r", 5, 2), (1, "p", 5, 1)]
    assert [r["docs"] for r in search.first_hits(copies, "shard", 1).collect()] in ([2], [3])
    assert search.count_all(copies).first()["count"] == 4


SOURCE = "k int, a string, b int"


def test_reconcile_rows(spark, rows):
    source = spark.createDataFrame([(1, "x", 1), (2, "x", None), (3, None, 3), (4, "r", 1), (4, "s", 1), (5, "p", 1),
                                    (5, "p", 1), (6, "m", 1), (8, None, 8)], SOURCE)
    target = spark.createDataFrame([(1, "x", 1), (2, "x", None), (3, "3", None), (4, "s", 1), (4, "r", 1), (5, "q", 1),
                                    (5, "q", 1), (7, "e", 1), (8, None, 8), (8, None, 8)], SOURCE)
    assert rows(reconcile.reconcile_rows(source, target, ["k"])) == [
        (3, 1, 1, "changed"), (5, 2, 2, "changed"), (6, 1, 0, "missing"), (7, 0, 1, "extra"), (8, 1, 2, "changed")]
    assert reconcile.reconcile_rows(source, source, ["k"]).count() == 0


def test_reconcile_bags_and_counts(spark, rows):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("y", None)], "c string, n int")
    b = spark.createDataFrame([("x", 1), ("y", None), ("z", 1)], "c string, n int")
    assert rows(reconcile.reconcile_bags(a, b)) == [("x", 1, 2, 1), ("z", 1, 0, 1)]
    assert rows(reconcile.reconcile_counts(a, b, ["c"])) == [
        ("x", 2, 1, "MISMATCH"), ("y", 1, 1, "OK"), ("z", 0, 1, "MISMATCH")]


def test_reconcile_schema(spark, rows):
    kind = "backup_id string, field string, target_type string"
    a = spark.createDataFrame([("b", "f", "long"), ("b", "g", "text"), ("b", "h", "text")], kind)
    b = spark.createDataFrame([("b", "f", "long"), ("b", "g", "keyword"), ("b", "i", "date")], kind)
    assert rows(reconcile.reconcile_schema(a, b), "field", "status") == [
        ("f", "same"), ("g", "retyped"), ("h", "missing"), ("i", "extra")]


def test_replicas(spark):
    good = ('{"index":{"number_of_replicas":"1"}}', '{"status":"green","active_primary_shards":2,"active_shards":4}')
    cases = [(*good, True), (good[0].replace('"1"', '"0"'), good[1], False), (good[0], good[1].replace("green", "yellow"), False),
             (good[0], good[1].replace("4", "3"), False), (good[0], "no reply", False), ("{}", good[1], False)]
    df = spark.createDataFrame([(str(i), 2, 2, s, h) for i, (s, h, _) in enumerate(cases)],
                               "backup_id string, shard_count int, replication_factor int, settings string, health string")
    got = {r["backup_id"]: r["passed"] for r in reconcile.replica_check(df).collect()}
    assert got == {str(i): c[2] for i, c in enumerate(cases)}


def test_statistics_by_record_order(spark):
    days = [dt.date(2024, 6, d) for d in (5, 1, 9, 3)]
    df = spark.createDataFrame([(i, "ab"[i % 2], "x", i * 10, d) for i, d in enumerate(days)],
                               "i int, g string, h string, m int, d date")
    got = {(r["dimension"], r["value"]): r for r in reconcile.dataset_stats(
        df, "i", F.col("m"), F.col("m"), "d", ["g", "h"]).collect()}
    everything = got[("all", None)]
    assert (everything["records"], everything["total"], everything["average"]) == (4, 60, 15.0)
    assert (everything["first_date"], everything["last_date"]) == (days[0], days[3])
    assert got[("g", "b")]["total"] == 40 and got[("g", "b")]["first_date"] == days[1]
    assert got[("h", "x")]["records"] == 4 and len(got) == 4


def test_expectations(spark, rows):
    results = reconcile.check_results(spark.range(5), {"n": F.count("*"), "s": F.sum("id"), "none": F.sum(F.lit(None).cast("int"))})
    wanted = spark.createDataFrame([("n", 5.0), ("s", 11.0), ("none", None), ("absent", 1.0)], "check string, value double")
    assert rows(reconcile.expected_matrix(results, wanted), "check", "passed") == [
        ("absent", False), ("n", True), ("none", False), ("s", False)]
    loose = spark.createDataFrame([("s", None)], "check string, value double")
    assert rows(reconcile.expected_matrix(results, loose), "check", "passed") == [("s", True)]
