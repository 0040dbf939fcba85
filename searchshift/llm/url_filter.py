"""Allow and block rules for addresses, by a sort-merge range join.

A rule (host, path) fits its host and all subdomains where the path of the address starts
with the rule's path; the longest fitting rule decides. Written from the top level down and
closed by a dot (``com.example.``), a host turns into a key whose prefixes are its parents,
so a rule's hosts are one interval of keys and any two intervals are nested or apart. Addresses
are dealt out by ranges of that key and sorted; each task then sweeps them along the
sorted rules, keeping the open intervals on a stack.

A range is cut by the key and a hash of the row's id, so a host with a third of all rows
is spread over many tasks. Rules are handed to every task only if there are at most
``max_rules``; above that addresses meet them by a join on the parents of their host, which
gives the same rows.

Defined results: an address that is null or has no ``://`` has empty host and path; an empty
path starts with no rule's ``/``; no rule fits: rule null and the verdict ``default``; of rules that
are equally long the one with the longer host decides, of equal rules ``block``; a rule with
null in it is ignored, a null path being ''; repeated rows and rows with null ids are
judged each alone; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most rules given to every task: about 20 MB.
MAX_RULES = 100_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class Sweep:
    """Open intervals along growing keys. ``rules``: (key of the host, host, path, verdict)."""

    def __init__(self, rules: list[tuple[str, str, str, str]]):
        self.rules = sorted(rules)
        self.next = 0
        #: (key, {path: (rank, rule, verdict)}, lengths of these paths)
        self.stack: list[tuple[str, dict, list[int]]] = []

    def move_to(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()
        while self.next < len(self.rules) and self.rules[self.next][0] <= key:
            opened = self.rules[self.next][0]
            paths: dict[str, tuple] = {}
            while self.next < len(self.rules) and self.rules[self.next][0] == opened:
                _, host, path, verdict = self.rules[self.next]
                rule = host + path
                paths[path] = max(paths.get(path, ()), ((len(rule), len(host), verdict), rule, verdict))
                self.next += 1
            if key.startswith(opened):
                self.stack.append((opened, paths, sorted({len(p) for p in paths}, reverse=True)))

    def judge(self, path: str) -> tuple[str | None, str | None]:
        best: tuple = ()
        for _, paths, lengths in self.stack:
            for n in lengths:
                if n <= len(path) and (found := paths.get(path[:n])):
                    best = max(best, found)
                    break
        return best[1:] if best else (None, None)


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", default: str = "allow",
          max_rules: int = MAX_RULES) -> DataFrame:
    """(key, host, path, rule, verdict) for every row of ``pages`` (key, url)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    rules = rules.where(F.col("host").isNotNull() & F.col("verdict").isNotNull()).select(
        host_key(F.col("host")).alias("key"), "host", F.coalesce("path", F.lit("")).alias("path"),
        "verdict").distinct()
    # one look, one row beyond the bound
    known = [tuple(r) for r in rules.limit(max_rules + 1).collect()]
    if len(known) > max_rules:
        return _by_parents(rows, rules, key, default)
    schema = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in ("rule", "verdict")]).schema

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = Sweep(known)
        for batch in batches:
            chosen = []
            for key_of_host, path_of_url in zip(batch["_key"].to_pylist(), batch["path"].to_pylist()):
                line.move_to(key_of_host)
                chosen.append(line.judge(path_of_url))
            yield pa.RecordBatch.from_arrays(
                [batch[key], batch["host"], batch["path"], pa.array([r for r, _ in chosen], pa.string()),
                 pa.array([v or default for _, v in chosen], pa.string())],
                names=[key, "host", "path", "rule", "verdict"])

    ordered = (rows.withColumn("_key", host_key(F.col("host")))
               .withColumn("_spread", F.xxhash64(key, "path"))
               .repartitionByRange("_key", "_spread").sortWithinPartitions("_key", "_spread"))
    return ordered.mapInArrow(sweep, schema)


def _by_parents(rows: DataFrame, rules: DataFrame, key: str, default: str) -> DataFrame:
    """The same by an equi-join of each distinct address with the rules of its host's parents."""
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = (rows.select("host", "path").distinct()
             .withColumn("parent", F.explode(parents))
             .join(rules.select(F.col("host").alias("parent"), F.col("path").alias("_path"), "verdict"), "parent")
             .where(F.expr("startswith(path, _path)")))
    best = found.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("parent") + F.length("_path")).alias("n"), F.length("parent").alias("h"), "verdict",
        F.concat("parent", "_path").alias("rule"))).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        key, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


#: The rules of the registered query.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))

#: The same rows in SQL.
ORACLE = f"""
WITH rules(h, p, v) AS (VALUES {', '.join(str(r) for r in RULES)}),
cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
parts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
urls AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
                regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts),
found AS (
  SELECT u.*, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) AS k
  FROM urls u LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM found WHERE k = 1"""
