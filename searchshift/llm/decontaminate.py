"""Documents that contain test items, by size-partitioned MinHash containment search.

Texts are compared by their runs of five words, lower-cased and without punctuation. A
document contains an item if it has at least 80 % of the item's distinct runs.

Items are partitioned by size, in powers of two. For a partition whose largest item has u
runs the signature is the k smallest hashes of an item, k = floor(0.2 u) + 1: a document that
contains an item of n runs lacks at most floor(0.2 n) < k of them, so at least k - floor(0.2 n)
of the signature are found in it, and none is lost. Looked up among the runs of long
documents, short signatures need no sketch of the document, whose own minima would say
nothing about an item a thousand times smaller. Candidates are then verified on all runs of
both sides.

Texts are moved once, to meet their candidates; runs never are, since the signatures go to
where the texts lie. That needs at most ``max_signatures`` of them; above that runs and
signatures meet in a shuffled join, which gives the same rows.

Defined results: null texts, texts and items of fewer than five words have no runs and no
hits; a document or item row that repeats gives one hit per document and item id; rows
that share an id but not the text are judged each alone and the best hit counts; null
ids are reported as null; no items, no hits; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .expressions import let, shingle_hashes, words_of

WORDS = 5
#: In hundredths.
THRESHOLD = 80
#: Most signature hashes given to every task: 64 MB as a hash table.
MAX_SIGNATURES = 2_000_000


def runs_of(text: Column) -> Column:
    """Hashes of all runs of five words, case and punctuation apart."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " ")
    return let(words_of(plain), lambda words: shingle_hashes(words, WORDS))


def signature_length(size: Column) -> Column:
    """Of an item with ``size`` runs: the same for all items of its partition."""
    largest = F.pow(F.lit(2.0), F.floor(F.log2(size)) + 1) - 1
    return (F.floor(largest * (100 - THRESHOLD) / 100) + 1).cast("int")


def _identified(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text): the id tells rows apart that share a key but not the text."""
    return rows.select(F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("text")).alias("id"),
                       F.col(text).alias("text"))


def contaminated(docs: DataFrame, items: DataFrame, max_signatures: int = MAX_SIGNATURES) -> DataFrame:
    """(doc, item, n_shared, n_item): ids with key and text hash, one row per verified hit."""
    docs = _identified(docs, "doc_id", "text").withColumnRenamed("id", "doc")
    sized = (_identified(items, "item_id", "text").distinct()
             .select(F.col("id").alias("item"), F.sort_array(F.array_distinct(runs_of(F.col("text")))).alias("runs"))
             .where(F.size("runs") > 0).withColumn("n_item", F.size("runs")))
    signed = sized.withColumn("k", F.least(signature_length(F.col("n_item")), F.col("n_item")))
    # a document may lack so many of them
    needed = F.col("k") - F.floor(F.col("n_item") * (100 - THRESHOLD) / 100)
    signatures = signed.select("item", needed.alias("needed"), F.explode(F.slice("runs", 1, F.col("k"))).alias("run"))
    if signatures.count() <= max_signatures:
        signatures = F.broadcast(signatures)
    probes = docs.select("doc", F.explode(runs_of(F.col("text"))).alias("run"))
    # written down, as it is read twice and is small beside the texts it comes from
    candidates = materialized(
        probes.join(signatures, "run").groupBy("doc", "item", "needed")
        .agg(F.count_distinct("run").alias("found")).where("found >= needed").select("doc", "item"), "candidates")
    wanted = candidates.join(sized, "item").select("doc", "item", "n_item", F.explode("runs").alias("run"))
    present = (docs.join(candidates.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"])
               .select("doc", F.explode(F.array_distinct(runs_of(F.col("text")))).alias("run")))
    return (wanted.join(present, ["doc", "run"]).groupBy("doc", "item", "n_item")
            .agg(F.count("*").alias("n_shared")).where(100 * F.col("n_shared") >= THRESHOLD * F.col("n_item"))
            .select("doc", "item", "n_shared", F.col("n_item").cast("long").alias("n_item")))


def hits(docs: DataFrame, items: DataFrame, **bounds) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item), the best row of each pair."""
    best = F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("part"), "n_shared", "n_item"))
    return (contaminated(docs, items, **bounds)
            .groupBy(F.col("doc.key").alias("doc_id"), F.col("item.key").alias("item_id"))
            .agg(best.alias("best")).select("doc_id", "item_id", "best.n_shared", "best.n_item"))


def without_items(docs: DataFrame, items: DataFrame, **bounds) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    dirty = contaminated(docs, items, **bounds).select(F.col("doc").alias("_doc")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    mine = F.struct(F.col("doc_id").alias("key"), F.xxhash64("text").alias("text")).alias("_doc")
    return docs.select(row, mine).join(dirty, "_doc", "left_anti").select("row.*")


#: The same rows in SQL.
ORACLE = """
WITH plain AS (
  SELECT 'd' AS side, doc_id AS id, md5(text) AS t, string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{M}\\p{N}]+', ' ', 'g')), ' ') AS w
  FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT 'i', item_id, md5(text), string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{M}\\p{N}]+', ' ', 'g')), ' ')
  FROM benchmark WHERE text IS NOT NULL),
runs AS (SELECT DISTINCT side, id, t, array_to_string(w[i:i + 4], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM plain WHERE len(w) >= 5)),
sizes AS (SELECT id, t, count(*) AS n_item FROM runs WHERE side = 'i' GROUP BY 1, 2),
shared AS (
  SELECT d.id AS doc_id, d.t AS dt, i.id AS item_id, i.t, count(*) AS n_shared
  FROM runs d JOIN runs i ON d.run = i.run AND d.side = 'd' AND i.side = 'i' GROUP BY 1, 2, 3, 4),
found AS (
  SELECT s.doc_id, s.item_id, n_shared, n_item, row_number() OVER (
    PARTITION BY s.doc_id, s.item_id ORDER BY n_shared / n_item DESC, n_shared DESC) AS k
  FROM shared s JOIN sizes z ON s.item_id = z.id AND s.t = z.t WHERE 100 * n_shared >= 80 * n_item)
SELECT doc_id, item_id, n_shared, n_item FROM found WHERE k = 1"""
