"""Plans that must hold when one group has a third of all rows."""

import os
import re

import pytest
from pyspark.sql import functions as F

from searchshift.functions.predicates import date_range, range_filter, term
from searchshift.operators import detect, documents, mapping, reconcile, validate
from searchshift.operators.joins import join_parents
from searchshift.plans.catalog import load_all

FOLDER = "/root/testdata/sf0.001"
on_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")
HEAVY = {"convert_backups", "conversion_issues", "watch_health"}


def physical(df, executed=False):
    if executed:
        df.collect()  # runs this very plan, so that its final form shows
    return df._jdf.queryExecution().executedPlan().toString()


@on_tables
@pytest.mark.parametrize("name", [n for n in load_all() if n not in HEAVY])
def test_no_product_and_no_single_group(spark, name):
    plan = physical(load_all()[name].run(spark, FOLDER))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)


@on_tables
def test_filters_and_columns_reach_the_scan(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    plan = physical(orders.filter(date_range(orders, "o_orderdate", gte="1997-06-01", lte="1997-06-30"))
                    .agg(F.count("*")))
    assert "GreaterThanOrEqual(o_orderdate,1997-06-01" in plan and "LessThan(o_orderdate,1" in plan
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan
    customers = spark.read.parquet(f"{FOLDER}/customer.parquet")
    plan = physical(customers.filter(term(F.col("c_mktsegment"), "X") & range_filter(F.col("c_acctbal"), gte=1.0))
                    .select("c_custkey"))
    assert "EqualTo(c_mktsegment,X)" in plan and "GreaterThanOrEqual(c_acc" in plan


@on_tables
def test_counting_reads_no_columns(spark):
    plan = physical(load_all()["count_all"].run(spark, FOLDER))
    assert "ReadSchema: struct<>" in plan


def test_classification_is_one_pass(spark, tmp_path):
    path = str(tmp_path / "inventory")
    spark.createDataFrame([("b", "", "", True, 0, True)], "backup_id string, rel_dir string, name string, "
                          "is_dir boolean, length bigint, readable boolean").write.parquet(path)
    plan = physical(detect.classify_format(spark.read.parquet(path)))
    assert plan.count("FileScan") == 1 and "Join" not in plan and plan.count("Exchange hash") == 2
    assert "StringStartsWith(name,segments_)" in plan


def test_reconciliation_is_one_shuffle(spark):
    a = spark.range(10).withColumn("v", F.col("id") * 2)
    plan = physical(reconcile.reconcile_rows(a, a, ["id"]))
    assert plan.count("Exchange hash") == 1 and "Join" not in plan


@pytest.fixture
def small_skew(spark):
    """Skew handling at test size."""
    wanted = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
              "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
              "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot(spark, n=60_000):
    """Rows of which a third belong to backup 0."""
    return spark.range(n).repartition(8).select(
        F.concat(F.lit("b"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5003)).alias("backup_id"),
        F.col("id"))


@pytest.fixture
def fixed_plan(spark):
    """Many partitions and no adaptive execution: what the plan itself achieves."""
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32",
              "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def hot_fields(spark):
    kind = F.concat(F.lit("custom"), (F.col("id") % 2 * (F.col("id") % 3)).cast("string"))
    fields = hot(spark).select("backup_id", F.col("id").alias("pos"), F.concat(F.lit("f"), "id").alias("name"),
                               kind.alias("type"))
    types = fields.select("backup_id", F.col("type").alias("name")).distinct().select(
        "backup_id", F.lit(0).cast("bigint").alias("pos"), "name", F.lit("solr.BoolField").alias("class"))
    return mapping.map_field_types(fields, types)


def hot_files(spark):
    return hot(spark).select("backup_id", F.lit(0).cast("bigint").alias("shard_id"),
                             F.concat(F.lit("_"), "id").alias("name"), F.col("id").alias("length"),
                             F.lit("c").alias("checksum"), F.lit("9.8.0").alias("written_by"),
                             F.lit(b"").alias("meta_hash"))


def hot_plan(spark):
    shards = hot(spark).select("backup_id", F.col("id").alias("shard_id"),
                               F.concat(F.lit("snapshot.shard"), F.col("id") + 1).alias("dir"))
    formats = shards.groupBy("backup_id").agg(
        F.when(F.max("shard_id") >= 0, F.lit("SOLRCLOUD_FULL")).alias("format"))
    return detect.plan_shards(formats, shards, spark.createDataFrame([], "backup_id string, index_dir string"))


@pytest.mark.parametrize("job", [hot_fields, hot_plan])
def test_hot_group_is_dealt_out(spark, fixed_plan, job):
    df = job(spark)
    assert df.count() == 60_000
    assert largest_share(df) < 0.2


def test_aggregated_parents_leave_the_join_splittable(spark, small_skew):
    rows = hot(spark)
    parents = rows.groupBy("backup_id").agg(F.count("*").alias("n"))
    df = join_parents(rows, parents, ["backup_id"], spread=["id"], salts=1)
    plan = physical(df, executed=True)
    assert "skew=true" in plan and "skewed" in plan
    assert df.filter("backup_id = 'b0'").first()["n"] > 20_000


def test_hot_shard_list_is_bounded(spark, fixed_plan):
    chunks = documents.file_chunks(hot_files(spark), 100)
    sizes = [r["n"] for r in chunks.select(F.regexp_count("names", F.lit('"name"')).alias("n")).collect()]
    assert sum(sizes) == 60_000 and max(sizes) < 200
    big = chunks.filter("backup_id = 'b0'")
    assert big.groupBy(F.spark_partition_id()).count().count() > 10


def test_hot_backup_is_planned_whole(spark, small_skew):
    shards = hot(spark).select("backup_id", F.col("id").alias("shard_number"))
    gaps = detect.shard_gaps(shards)
    assert gaps.filter("backup_id = 'b0'").collect()[0]["expected"] == 1
    many = spark.range(1, 30_001).select(F.lit("whole").alias("backup_id"), F.col("id").alias("shard_number"))
    assert detect.shard_gaps(many).count() == 0
    assert [r["expected"] for r in detect.shard_gaps(many.filter("shard_number <> 17171")).collect()] == [17171]


def test_hot_backup_in_the_gate(spark, small_skew):
    issues = hot(spark).select("backup_id", F.lit("WARN").alias("severity"), F.lit("NO_DOCUMENTS").alias("code"))
    summary = validate.issue_summary(issues).filter("code IS NULL AND severity = 'WARN'").first()
    assert summary["issues"] == 60_000


@on_tables
@pytest.mark.parametrize("name", ["segment_health", "shard_rollup", "index_doc", "repo_index_doc"])
def test_versions_are_aggregated_by_hash(spark, name):
    plan = physical(load_all()[name].run(spark, FOLDER))
    assert not re.search("SortAggregate.*max", plan)
