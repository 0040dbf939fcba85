"""Verification of a restored index, reconciliation and cluster status."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.predicates import date_range, match_text, range_filter, term
from ..operators import mapping, reconcile, search, status
from .catalog import query

TOKENS = "list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


def tokens_sql(column: str) -> str:
    return TOKENS.format(c=column)


@query("count_all", "SELECT count(*) AS count FROM lineitem")
def _(t):
    return search.count_all(t.lineitem)


@query("match_text", f"""
SELECT doc_id, lang, source FROM documents WHERE list_contains({tokens_sql('text')}, 'the')""")
def _(t):
    return t.documents.filter(match_text(F.col("text"), "The")).select("doc_id", "lang", "source")


@query("match_any", f"""
SELECT doc_id FROM documents WHERE list_contains({tokens_sql('text')}, 'license')
  OR list_contains({tokens_sql('text')}, 'été') OR list_contains({tokens_sql('text')}, 'und')""")
def _(t):
    return t.documents.filter(match_text(F.col("text"), "license été UND")).select("doc_id")


@query("match_all_tokens", f"""
SELECT p_partkey, p_name FROM part WHERE list_contains({tokens_sql('p_name')}, 'red')
  AND list_contains({tokens_sql('p_name')}, 'widget')""")
def _(t):
    return t.part.filter(match_text(F.col("p_name"), "Red Widget", operator="and")).select(
        "p_partkey", "p_name")


@query("match_counts", f"""
SELECT source, lang, count(*) AS matches FROM documents
WHERE list_contains({tokens_sql('text')}, 'of') GROUP BY 1, 2""")
def _(t):
    return t.documents.filter(match_text(F.col("text"), "of")).groupBy("source", "lang").agg(
        F.count("*").alias("matches"))


@query("term_keyword", """
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def _(t):
    return t.customer.filter(term(F.col("c_mktsegment"), "MACHINERY")).select("c_custkey", "c_name")


@query("term_on_text", """
SELECT count(*) FILTER (WHERE false) AS term_hits, count(*) FILTER (WHERE lower(c_mktsegment) = 'machinery') AS match_hits FROM customer""")
def _(t):
    def hits(predicate: str):
        return F.count_if(search.field_predicate(
            F.col("c_mktsegment"), "MACHINERY", "text", predicate))

    return t.customer.agg(hits("term").alias("term_hits"), hits("match").alias("match_hits"))


@query("range_numeric", "SELECT count(*) AS count FROM lineitem WHERE l_quantity >= 20")
def _(t):
    return search.count_where(t.lineitem, range_filter(F.col("l_quantity"), gte=20.0))


@query("range_bounds", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity > 10 AND l_quantity <= 12 AND l_discount < 0.05""")
def _(t):
    return t.lineitem.filter(
        range_filter(F.col("l_quantity"), gt=10.0, lte=12.0)
        & range_filter(F.col("l_discount"), lt=0.05)
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("range_date", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-06-01' AND o_orderdate < TIMESTAMP '1997-07-01'""")
def _(t):
    orders = t.orders
    return orders.filter(date_range(orders, "o_orderdate", gte="1997-06-01", lte="1997-06-30")
                         ).select("o_orderkey", "o_orderdate")


@query("range_date_open", """
SELECT event_type, count(*) AS count FROM events
WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-06' GROUP BY 1""")
def _(t):
    events = t.events
    return events.filter(date_range(events, "ts", gt="2024-01-02", lt="2024-01-06")).groupBy(
        "event_type").agg(F.count("*").alias("count"))


def _cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


@query("metric_aggs", """
SELECT avg(l_quantity) AS avg_quantity, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total_cents,
  avg(CAST(round(l_discount * 100) AS BIGINT)) AS avg_discount_percent FROM lineitem""")
def _(t):
    lines = t.lineitem.select("l_quantity", _cents("l_extendedprice").alias("price_cents"),
                              _cents("l_discount").alias("discount_percent"))
    return search.metric_aggs(lines, {
        "avg_quantity": ("avg", "l_quantity"), "total_cents": ("sum", "price_cents"),
        "avg_discount_percent": ("avg", "discount_percent")})


@query("docs_per_shard", """
SELECT shard, prirep, CAST(sum(docs) AS BIGINT) AS docs, count(*) AS copies FROM fx_copies GROUP BY 1, 2""")
def _(t):
    return search.docs_per_shard(t.fx_copies)


@query("first_hits", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def _(t):
    return search.first_hits(t.orders, "o_orderkey", 5)


@query("field_query", f"""
SELECT 'text' AS kind, p_partkey FROM part WHERE list_contains({tokens_sql('p_name')}, 'steel')
UNION ALL SELECT 'keyword', p_partkey FROM part WHERE p_brand = 'Brand#17'
UNION ALL SELECT 'integer', p_partkey FROM part WHERE p_size = 11
UNION ALL SELECT 'everything', p_partkey FROM part""")
def _(t):
    part = t.part
    types = {"p_name": "text", "p_brand": "keyword", "p_size": "integer"}

    def ask(kind: str, expression: str):
        return search.field_query(part, expression, types).select(
            F.lit(kind).alias("kind"), "p_partkey")

    return (ask("text", "p_name:STEEL").unionByName(ask("keyword", "p_brand:Brand#17"))
            .unionByName(ask("integer", "p_size:11")).unionByName(ask("everything", "*:*"))
            .unionByName(ask("undeclared", "nothing:x")))


@query("reconcile_counts", """
WITH s AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1),
r AS (SELECT o_orderstatus, count(*) AS n FROM fx_restored GROUP BY 1)
SELECT o_orderstatus, coalesce(s.n, 0) AS source_count, coalesce(r.n, 0) AS target_count,
  CASE WHEN s.n = r.n THEN 'OK' ELSE 'MISMATCH' END AS status FROM s FULL JOIN r USING (o_orderstatus)""")
def _(t):
    return reconcile.reconcile_counts(t.orders, t.fx_restored, ["o_orderstatus"])


@query("reconcile_rows", """
SELECT coalesce(s.o_orderkey, r.o_orderkey) AS o_orderkey, CAST(s.o_orderkey IS NOT NULL AS BIGINT) AS source_rows,
  CAST(r.o_orderkey IS NOT NULL AS BIGINT) AS target_rows,
  CASE WHEN r.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS status
FROM orders s FULL JOIN fx_restored r ON r.o_orderkey = s.o_orderkey
WHERE s.o_orderkey IS NULL OR r.o_orderkey IS NULL OR s.o_custkey IS DISTINCT FROM r.o_custkey
  OR s.o_orderstatus IS DISTINCT FROM r.o_orderstatus OR s.o_totalprice IS DISTINCT FROM r.o_totalprice
  OR s.o_orderdate IS DISTINCT FROM r.o_orderdate OR s.o_orderpriority IS DISTINCT FROM r.o_orderpriority""")
def _(t):
    return reconcile.reconcile_rows(t.orders, t.fx_restored, ["o_orderkey"])


@query("reconcile_bags", """
WITH s AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2),
r AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM fx_restored GROUP BY 1, 2)
SELECT o_custkey, o_orderstatus, coalesce(s.n, 0) AS source_rows, coalesce(r.n, 0) AS target_rows
FROM s FULL JOIN r USING (o_custkey, o_orderstatus) WHERE s.n IS DISTINCT FROM r.n""")
def _(t):
    return reconcile.reconcile_bags(t.orders.select("o_custkey", "o_orderstatus"),
                                    t.fx_restored.select("o_custkey", "o_orderstatus"))


@query("replica_check", """
WITH v AS (
  SELECT backup_id, shard_count, replication_factor,
    CAST(json_extract_string(settings, '$.index.number_of_replicas') AS INTEGER) AS actual_replicas,
    CAST(json_extract_string(health, '$.active_primary_shards') AS INTEGER) AS actual_primaries,
    CAST(json_extract_string(health, '$.active_shards') AS INTEGER) AS actual_shards,
    json_extract_string(health, '$.status') AS health FROM fx_settings)
SELECT backup_id, replication_factor - 1 AS expected_replicas, actual_replicas, shard_count AS expected_primaries,
  actual_primaries, shard_count * replication_factor AS expected_shards, actual_shards, health,
  actual_replicas = replication_factor - 1 AND actual_primaries = shard_count
    AND actual_shards = shard_count * replication_factor AND health = 'green' AS passed FROM v""")
def _(t):
    return reconcile.replica_check(t.fx_settings)


@query("dataset_stats", """
WITH v AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
SELECT 'all' AS dimension, NULL AS value, count(*) AS records, CAST(sum(cents) AS BIGINT) AS total,
  avg(o_custkey) AS average, arg_min(o_orderdate, o_orderkey) AS first_date, arg_max(o_orderdate, o_orderkey) AS last_date FROM v
UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*), CAST(sum(cents) AS BIGINT), avg(o_custkey),
  arg_min(o_orderdate, o_orderkey), arg_max(o_orderdate, o_orderkey) FROM v GROUP BY o_orderstatus
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*), CAST(sum(cents) AS BIGINT), avg(o_custkey),
  arg_min(o_orderdate, o_orderkey), arg_max(o_orderdate, o_orderkey) FROM v GROUP BY o_orderpriority""")
def _(t):
    return reconcile.dataset_stats(t.orders, "o_orderkey", _cents("o_totalprice"),
                                   F.col("o_custkey"), "o_orderdate",
                                   ["o_orderstatus", "o_orderpriority"])


def order_checks(orders):
    """Ten checks of restored orders, of all the kinds that a restored index is asked."""
    def average(column):
        return F.sum(F.round(column).cast("bigint")) / F.count("*")

    return {
        "total": F.count("*"),
        "status F": F.count_if(term(F.col("o_orderstatus"), "F")),
        "price from 150000": F.count_if(range_filter(F.col("o_totalprice"), gte=150000.0)),
        "June 1997": F.count_if(date_range(orders, "o_orderdate", gte="1997-06-01", lte="1997-06-30")),
        "urgent": F.count_if(match_text(F.col("o_orderpriority"), "urgent")),
        "customers from 50": F.count_if(range_filter(F.col("o_custkey"), gte=50)),
        "not specified": F.count_if(match_text(F.col("o_orderpriority"), "not specified", "and")),
        "average price": average(F.col("o_totalprice") * 100),
        "total revenue": F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")),
        "average customer": average(F.col("o_custkey")),
    }


NUMBERS_ONLY = ("average price", "total revenue", "average customer")


@query("expected_matrix", f"""
WITH sides AS (
  SELECT false AS restored, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_custkey FROM orders
  UNION ALL SELECT true, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_custkey FROM fx_restored),
results AS (
  SELECT restored, unnest(['total', 'status F', 'price from 150000', 'June 1997', 'urgent', 'customers from 50',
      'not specified', 'average price', 'total revenue', 'average customer']) AS check,
    unnest([count(*)::DOUBLE, count_if(o_orderstatus = 'F')::DOUBLE, count_if(o_totalprice >= 150000)::DOUBLE,
      count_if(year(o_orderdate) = 1997 AND month(o_orderdate) = 6)::DOUBLE, count_if(o_orderpriority LIKE '%URGENT%')::DOUBLE,
      count_if(o_custkey >= 50)::DOUBLE, count_if(o_orderpriority LIKE '%NOT SPECIFIED%')::DOUBLE,
      sum(CAST(round(o_totalprice * 100) AS BIGINT))::DOUBLE / count(*), sum(CAST(round(o_totalprice * 100) AS BIGINT))::DOUBLE,
      sum(o_custkey)::DOUBLE / count(*)]) AS value
  FROM sides GROUP BY restored)
SELECT e.check, a.value AS actual,
  CASE WHEN e.check IN ('average price', 'total revenue', 'average customer') THEN NULL ELSE e.value END AS expected,
  CASE WHEN e.check IN ('average price', 'total revenue', 'average customer') THEN a.value IS NOT NULL
    ELSE a.value = e.value END AS passed
FROM results e JOIN results a ON a.check = e.check AND a.restored AND NOT e.restored""")
def _(t):
    restored, value = t.fx_restored, F.when(~F.col("check").isin(*NUMBERS_ONLY), F.col("value"))
    return reconcile.expected_matrix(
        reconcile.check_results(restored, order_checks(restored)),
        reconcile.check_results(t.orders, order_checks(t.orders)).withColumn("value", value))


# --- cluster status --------------------------------------------------------------


@query("shard_leaders", """
SELECT 'k' || o_orderkey AS cluster_id, 'coll' || o_custkey AS collection, 2 AS shard_count,
  CASE WHEN o_orderkey % 4 = 0 THEN '?' ELSE CAST(o_orderkey % 3 AS VARCHAR) END AS replication_factor, s.shard,
  CASE WHEN s.shard = 'shard1' THEN 2 WHEN o_orderkey % 5 = 0 THEN 0 ELSE 1 END AS replicas,
  CASE WHEN s.shard = 'shard1' THEN 'n' || (o_custkey % 5) ELSE '?' END AS leader_node
FROM orders, (VALUES ('shard1'), ('shard2')) s(shard)""")
def _(t):
    return status.shard_leaders(t.fx_status, ["cluster_id"])


@query("live_nodes", """
SELECT 'k' || o_orderkey AS cluster_id, unnest([0, 1, 2]) AS position,
  unnest(['a1', 'n' || (o_custkey % 5), 'n9']) AS node FROM orders""")
def _(t):
    return status.live_nodes(t.fx_status, ["cluster_id"])


@query("nodes_ready", """
SELECT 'k' || o_orderkey AS cluster_id, 3 AS nodes, CAST(o_orderkey % 3 + 2 AS INTEGER) AS expected_nodes,
  3 >= o_orderkey % 3 + 2 AS ready FROM orders""")
def _(t):
    return status.nodes_ready(t.fx_status, ["cluster_id"], F.col("expected_nodes"))


HEALTH = """
samples AS (
  SELECT event_id, index_name, ts,
    coalesce(CAST(json_extract_string(CASE WHEN json_valid(content) THEN content END, '$.number_of_nodes') AS INTEGER), 0) AS nodes,
    coalesce(json_extract_string(CASE WHEN json_valid(content) THEN content END, '$.status'), 'red') AS status
  FROM fx_health)"""


@query("health_ready", f"""
WITH {HEALTH} SELECT event_id, nodes, status, nodes >= 3 AND status = 'green' AS cluster_ready,
  CASE WHEN status = 'green' THEN 'done' ELSE 'waiting' END AS restore_state FROM samples""")
def _(t):
    return status.health_ready(t.fx_health, F.lit(3)).select(
        "event_id", "nodes", "status", "cluster_ready", "restore_state")


@query("wait_outcome", f"""
WITH {HEALTH}, spans AS (
  SELECT index_name, min(ts) AS started, max(ts) AS last_sample,
    min(CASE WHEN nodes >= 3 AND status = 'green' THEN ts END) AS ready_at FROM samples GROUP BY 1)
SELECT *, CASE WHEN ready_at <= started + INTERVAL 86400 SECONDS THEN 'ready'
  WHEN last_sample >= started + INTERVAL 86400 SECONDS THEN 'timeout' ELSE 'waiting' END AS outcome FROM spans""")
def _(t):
    samples = status.health_ready(t.fx_health, F.lit(3))
    return status.wait_outcome(samples, ["index_name"], "ts", F.col("cluster_ready"), 86400)
