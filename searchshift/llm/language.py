"""Language of pages and documents by Bayesian fusion of four kinds of evidence.

* Text: likelihood of its hashed byte triples under each language, with counts from all labelled
  documents. Triples of a text depend on each other, so their log-likelihood is
  tempered by ``TEMPER``.
* Declared language in the markup: P(declared | language) is estimated from what pages of
  each language, by text, declare; a missing or unknown declaration is a value of its own.
* Address suffix and host: the prior of a page is that of its host, smoothed towards its domain, that
  towards its suffix, that towards all pages. Each level is a grouped sum of first-pass
  posteriors, without the page's own share, so no page is its own evidence.

Counts are sums over all rows, made per task and then merged; the text model has
languages x 8192 numbers and the declaration table languages + 2 rows, whatever the input.
Hosts are joined with salt, since one may have a third of all pages.

Defined results: null and empty texts say nothing, and what remains decides; without an address
the prior is that of all pages; labels that are null or empty are not learned from; repeated
rows are judged each; no labels at all: language and confidence null; ties go to the
alphabetically first language; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_parents
from ..session import materialized
from .expressions import let
from .tokens import slices
from .url_filter import host_and_path

BUCKET_BITS = 13
TEMPER = 0.1
#: Pseudo-pages that each level of the prior borrows from the level above.
STRENGTH = 5.0
MAX_LANGUAGES = 500


def _triples(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed triple at each byte, and where each text's triples begin; those across texts are left out."""
    small = [(t or "").lower().encode() for t in texts.to_pylist()]
    data = np.frombuffer(b"".join(small), np.uint8).astype(np.uint32)
    ends = np.cumsum([len(t) for t in small], dtype=np.int64)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    h = (data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)
    inside = np.ones(len(h), dtype=bool)
    for back in (1, 2):
        crossing = ends[:-1] - back
        inside[crossing[(crossing >= 0) & (crossing < len(h))]] = False
    counts = np.concatenate([[0], np.cumsum(inside)])
    return (h[inside] >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), counts[
        np.minimum(np.concatenate([[0], ends]), len(h))]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for at, n in slices(batch["text"]):
            grams, bounds = _triples(batch["text"].slice(at, n))
            langs, code = np.unique(np.array(batch["lang"].slice(at, n).to_pylist(), dtype=object), return_inverse=True)
            owner = np.repeat(code, np.diff(bounds))
            counts = np.bincount((owner << BUCKET_BITS) + grams, minlength=len(langs) << BUCKET_BITS)
            for k, lang in enumerate(langs):
                part = counts[k << BUCKET_BITS:(k + 1) << BUCKET_BITS]
                sums[lang] = sums.get(lang, 0) + part
    for lang, counts in sums.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()),
                                          pa.array(counts[some], pa.int64())], names=["lang", "bucket", "n"])


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log-probability of each bucket per language) from all rows of (lang, text)."""
    known = labelled.where("lang is not null and lang <> ''").select("lang", "text")
    counted = materialized(known.mapInArrow(_count, "lang string, bucket int, n long")
                           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "triples")
    langs = [r[0] for r in counted.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    sums = np.ones((len(langs), 1 << BUCKET_BITS))  # add-one smoothing
    rows = counted.toArrow()
    place = {lang: k for k, lang in enumerate(langs)}
    sums[[place[x] for x in rows["lang"].to_pylist()], rows["bucket"].to_numpy()] += rows["n"].to_numpy()
    return langs, np.log(sums / sums.sum(axis=1, keepdims=True))


def visible_text(html: Column) -> Column:
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, "&[A-Za-z0-9#]+;", " ")


def declared_language(html: Column) -> Column:
    return F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})\b""", 1))


def evidence(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, host, declared, text) of pages (key, url, html)."""
    return pages.select(key, host_and_path(F.col("url"))[0].alias("host"),
                        F.coalesce(declared_language(F.col("html")), F.lit("")).alias("declared"),
                        visible_text(F.col("html")).alias("text"))


def _softmax(scores: Column) -> Column:
    return let(scores, lambda s: let(F.transform(s, lambda x: F.exp(x - F.array_max(s))), lambda e: let(
        F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(e, lambda x: x / total))))


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], key: str = "page_id",
             strength: float = STRENGTH) -> DataFrame:
    """(key, lang, confidence) of every row of (key, host, declared, text)."""
    langs, weights = model
    if not langs:
        return rows.select(key, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"))
    weights = weights.astype(np.float32)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch["text"], 2 << 20):
                grams, bounds = _triples(batch["text"].slice(at, n))
                scores = np.empty((n, len(langs)))
                for k in range(len(langs)):
                    sums = np.concatenate([[0.0], np.cumsum(weights[k][grams], dtype=np.float64)])
                    scores[:, k] = TEMPER * (sums[bounds[1:]] - sums[bounds[:-1]])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(langs), pa.int32()),
                                                 pa.array(scores.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch[c].slice(at, n) for c in (key, "host", "declared")] + [lists],
                                                 names=[key, "host", "declared", "scores"])

    rows = rows.select(key, F.coalesce("host", F.lit("")).alias("host"), F.coalesce("declared", F.lit("")).alias("declared"),
                       "text")
    kind = rows.schema[key].dataType.simpleString()
    scored = materialized(rows.mapInArrow(
        score, f"`{key}` {kind}, host string, declared string, scores array<double>"), "scores")
    said = F.when(F.col("declared").isin(langs), F.col("declared")).when(F.col("declared") == "", "").otherwise("?")
    sums = [F.sum(F.col("q")[k]).alias(f"q{k}") for k in range(len(langs))]

    # what pages of each language, by text alone, declare: langs + 2 rows
    by_text = scored.select(said.alias("said"), _softmax(F.col("scores")).alias("q"))
    table = {r["said"]: [r[f"q{k}"] for k in range(len(langs))] for r in by_text.groupBy("said").agg(*sums).collect()}
    totals = np.sum(list(table.values()), axis=0) if table else np.zeros(len(langs))
    given = {s: [math.log((table.get(s, [0.0] * len(langs))[k] + 1) / (totals[k] + len(langs) + 2))
                 for k in range(len(langs))] for s in [*langs, "", "?"]}
    chosen = F.lit(None)
    for value, logs in given.items():
        chosen = F.when(said == value, F.array(*map(F.lit, logs))).otherwise(chosen)
    common = (totals + 1) / (totals.sum() + len(langs))
    overall = F.array(*[F.lit(float(p)) for p in common])

    # first pass: text, declaration and the overall prior
    first = scored.withColumn("likelihood", _plus(F.col("scores"), chosen)).withColumn(
        "q", _softmax(_plus(F.col("likelihood"), F.array(*[F.lit(math.log(p)) for p in common]))))
    first = first.select(key, "host", "likelihood", "q")
    sized = lambda name: F.array(*[F.col(f"q{k}") for k in range(len(langs))]).alias(name)
    hosts = materialized(first.where("host <> ''").groupBy("host").agg(*sums)
                         .withColumn("domain", F.substring_index("host", ".", -2))
                         .withColumn("suffix", F.substring_index("host", ".", -1)), "hosts")
    again = [F.sum(f"q{k}").alias(f"q{k}") for k in range(len(langs))]
    domains = hosts.groupBy("domain").agg(*again).select("domain", sized("of_domain"))
    suffixes = hosts.groupBy("suffix").agg(*again).select("suffix", sized("of_suffix"))
    levels = join_parents(join_parents(hosts.select("host", "domain", "suffix", sized("of_host")), suffixes,
                                       ["suffix"], ["host"]), domains, ["domain"], ["host"])
    levels = levels.select("host", "of_suffix", "of_domain", "of_host")

    def smoothed(counts: Column, own: Column, above: Column) -> Column:
        rest = F.zip_with(counts, own, lambda n, q: F.greatest(n - q, F.lit(0.0)))
        return let(rest, lambda r: let(F.aggregate(r, F.lit(strength), lambda a, x: a + x), lambda total: F.zip_with(
            r, above, lambda n, p: (n + strength * p) / total)))

    placed = join_parents(first, levels, ["host"], [key], "left")
    prior = F.when(F.col("of_host").isNull(), overall).otherwise(let(
        smoothed(F.col("of_suffix"), F.col("q"), overall), lambda s: let(
            smoothed(F.col("of_domain"), F.col("q"), s), lambda d: smoothed(F.col("of_host"), F.col("q"), d))))
    final = placed.select(key, _softmax(_plus(F.col("likelihood"), F.transform(prior, lambda p: F.log(p)))).alias("q"))
    best = F.array_max(F.col("q"))
    return final.select(key, F.get(F.array(*map(F.lit, langs)), (F.array_position("q", best) - 1).cast("int")).alias("lang"),
                        best.alias("confidence"))
