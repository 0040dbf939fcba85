"""Collocations: phrases of two or three words that occur together more than by chance.

The one structure behind it is the stripe: a prefix of one or two words with a counter of the words
that follow it. Every task counts its share of the texts into stripes and sends them, packed,
to buckets by prefix; a bucket merges the stripes of a prefix by adding up their counters. What is
asked for is read off the merged stripes of a language:

* an entry is the frequency of the prefix and its next word, an extension;
* the total of a one-word prefix, with the ends of pieces counted as well, is the frequency of
  the word; that of a two-word prefix is its entry in the stripe of its first word;
* the greatest entry of a prefix is the most frequent phrase that the prefix starts, and the greatest
  count of a word after prefixes that end alike the most frequent one that ends so: a phrase is subsumed
  if either has half its frequency.

Words travel as 64-bit numbers, one dictionary per packet; the words themselves go once from
each task to the bucket of their number, where two words with one number are found
out: then the count is made again with another seed, so no number ever stands for two words. A
prefix that everything follows, a stripe with very many entries, is cut into 16 by the next
word; totals are counted on their own for that reason. Only frequent entries leave the buckets.

Ranks come from a range sort, so a language of any size is spread. All arithmetic is on integers
and decimals without places.

Defined results: a null text is an empty one and a null language ``und``; repeated rows count each; ties
in score and frequency go by the phrase, in the order of its bytes; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .hashing import mix
from .ranked import places
from .tokens import slices

#: Bytes between pieces, and the word that stands for them.
SEPARATORS, END = b".,;:!?\n\x0b\x0c\r", b"\n"
_TABLE = bytes(END[0] if b in SEPARATORS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes of text counted at a time, per bucket, and buckets at most.
FLUSH_BYTES, BUCKET_BYTES, MOST_BUCKETS = 8 << 20, 32 << 20, 1 << 16
#: Parts of a stripe, by the next word.
PARTS = 16
#: Least frequency of a phrase, share of it (in hundredths) that a longer one needs to subsume it, and results per language.
LEAST, SUBSUMED, MOST = 10, 50, 2000

PACKETS = "bucket int, lang string, payload binary"
#: size: words in the phrase; words of one size only: its string. size 0: words of a language; size -1: two words have a number.
FOUND = "lang string, size int, x long, y long, z long, n long, word string"


@dataclass
class Stripes:
    """Counted phrases of one length as parallel columns, in the order of their words."""
    words: list[np.ndarray]
    counts: np.ndarray


def _counted(columns: list[np.ndarray], counts: np.ndarray) -> Stripes:
    """Equal phrases merged. Columns are numbers of any size."""
    if not len(counts):
        return Stripes(columns, counts)
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.zeros(len(counts), dtype=bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return Stripes([c[first] for c in columns], np.add.reduceat(counts[order], first))


def _phrases(ids: np.ndarray, end: int, many: int, size: int) -> Stripes:
    """All phrases of ``size`` words inside pieces, counted; words are numbers below ``many``."""
    n = len(ids) - size + 1
    if n <= 0:
        return Stripes([np.zeros(0, np.int64)] * size, np.zeros(0, np.int64))
    inside = np.ones(n, dtype=bool)
    for k in range(size):
        inside &= ids[k:k + n] != end
    if many ** size >= 1 << 63:
        return _counted([ids[k:k + n][inside] for k in range(size)], np.ones(int(inside.sum()), np.int64))
    key = np.zeros(n, dtype=np.int64)
    for k in range(size):
        key = key * many + ids[k:k + n]
    key, counts = np.unique(key[inside], return_counts=True)
    words = []
    for _ in range(size):
        key, last = np.divmod(key, many)
        words.insert(0, last)
    return Stripes(words, counts)


def _runs(stripes: Stripes) -> np.ndarray:
    """Where the stripes begin: rows that share all words but the last."""
    new = np.zeros(len(stripes.counts), dtype=bool)
    new[:1] = True
    for c in stripes.words[:-1]:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _pack(words: list[bytes], hashes: np.ndarray, totals: np.ndarray, two: Stripes, three: Stripes) -> bytes:
    """A packet: words with totals, and stripes of one- and two-word prefixes in numbers of its own dictionary."""
    used, place = np.unique(np.concatenate([*two.words, *three.words]), return_inverse=True)
    kind = "<u2" if len(used) < 1 << 16 else "<u4"
    text = END.join(words)
    parts, at = [], 0
    for stripes in (two, three):
        own = []
        for _ in stripes.words:
            own.append(place[at:at + len(stripes.counts)])
            at += len(stripes.counts)
        first = _runs(stripes)
        lengths = np.diff(first, append=len(stripes.counts))
        parts += [own[k][first].astype(kind) for k in range(len(own) - 1)]
        parts += [lengths.astype("<u4"), own[-1].astype(kind), stripes.counts.astype("<u8")]
    columns = [np.array([len(text)], "<u8"), hashes[used].astype("<u8"), totals.astype("<u8")]
    sizes = np.array([len(words), len(used), len(parts[1]), len(two.counts), len(parts[5]), len(three.counts)], "<u8")
    body = b"".join([sizes.tobytes(), *(c.tobytes() for c in columns), text, *(p.tobytes() for p in parts)])
    return zstandard.ZstdCompressor(3).compress(body)


def _unpack(payload: bytes) -> tuple[list[bytes], np.ndarray, list[np.ndarray], np.ndarray, list[np.ndarray], np.ndarray]:
    """(words, totals, columns of numbers and counts of the pairs, the same of the triples)."""
    body, at = zstandard.ZstdDecompressor().decompress(payload), 0

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    n_words, n_used, n_one, n_two, n_pairs, n_three = take("<u8", 6).tolist()
    length = int(take("<u8", 1)[0])
    dictionary, totals = take("<u8", n_used), take("<u8", n_words)
    text = body[at:at + length]
    at += length
    words = text.split(END) if n_words else []
    kind = "<u2" if n_used < 1 << 16 else "<u4"
    out = []
    for prefix, stripes, entries in ((1, n_one, n_two), (2, n_pairs, n_three)):
        heads = [take(kind, stripes) for _ in range(prefix)]
        lengths = take("<u4", stripes)
        columns = [np.repeat(dictionary[h], lengths) for h in heads] + [dictionary[take(kind, entries)]]
        out += [columns, take("<u8", entries).astype(np.int64)]
    return words, totals.astype(np.int64), *out


def _number(word: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(word, seed=seed)


def _packets(lang: str, text: bytes, buckets: int, seed: int) -> Iterator[tuple[int, str, bytes]]:
    """The stripes of a run of texts of one language, by bucket."""
    split = pc.split_pattern(pa.array([text.replace(END, b" \n ") + b" \n "], pa.large_binary()), " ")
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    ids, many, end = coded.indices.to_numpy().astype(np.int64), len(words), words.index(END)
    del split, coded
    if b"" in words:  # between blanks
        ids = ids[ids != words.index(b"")]
    hashes = np.array([_number(w, seed) for w in words], np.uint64)
    totals = np.bincount(ids, minlength=many)
    totals[end] = 0
    spread = mix(hashes + np.uint64(seed + 1))
    part = spread % np.uint64(PARTS)
    place = lambda x: (mix(x) % np.uint64(buckets)).astype(np.int64)
    two, three = (_phrases(ids, end, many, size) for size in (2, 3))
    one_at = place(spread)
    one = np.flatnonzero(totals)
    one = one[np.argsort(one_at[one], kind="stable")]
    sides = []
    for stripes in (two, three):
        prefix = spread[stripes.words[0]]
        for w in stripes.words[1:-1]:
            prefix = mix(prefix * np.uint64(0x9E3779B97F4A7C15) + spread[w])
        at = place(prefix * np.uint64(PARTS) + part[stripes.words[-1]])
        order = np.argsort(at, kind="stable")
        sides.append((Stripes([w[order] for w in stripes.words], stripes.counts[order]), at[order]))
    for bucket in np.unique(np.concatenate([one_at[one], *(at for _, at in sides)])).tolist():
        a, b = np.searchsorted(one_at[one], [bucket, bucket + 1])
        mine = one[a:b]
        cut = []
        for stripes, at in sides:
            i, j = np.searchsorted(at, [bucket, bucket + 1])
            cut.append(Stripes([w[i:j] for w in stripes.words], stripes.counts[i:j]))
        yield bucket, lang, _pack([words[k] for k in mine.tolist()], hashes, totals[mine], *cut)


def _count(buckets: int, seed: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        whole = 0

        def flushed(lang: str) -> pa.RecordBatch:
            nonlocal whole
            whole -= sizes.pop(lang)
            out = list(_packets(lang, END.join(held.pop(lang)), buckets, seed))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[], [], []], [pa.int32(), pa.string(), pa.binary()])],
                names=["bucket", "lang", "payload"])

        for batch in batches:
            for at, n in slices(batch["text"]):
                langs = batch["lang"].slice(at, n).to_pylist()
                texts = batch["text"].slice(at, n).cast(pa.large_binary()).to_pylist()
                for lang, text in zip(langs, texts):
                    held.setdefault(lang, []).append(text.translate(_TABLE))
                    sizes[lang] = sizes.get(lang, 0) + len(text)
                    whole += len(text)
                    if sizes[lang] >= FLUSH_BYTES or whole >= 4 * FLUSH_BYTES:
                        yield flushed(max(sizes, key=sizes.get))
        for lang in list(held):
            yield flushed(lang)
    return job


def _merge(least: int, seed: int):
    def job(packets: pa.Table) -> pa.Table:
        """Frequent entries and totals of a bucket."""
        rows: dict[str, list] = {c: [] for c in ("lang", "size", "x", "y", "z", "n", "word")}

        def add(lang, size, columns, counts, words=None):
            n = len(counts)
            columns = [c.view(np.int64) for c in columns] + [None] * (3 - len(columns))
            for name, c in zip("xyz", columns):
                rows[name].append(pa.nulls(n, pa.int64()) if c is None else pa.array(c))
            rows["lang"].append(pa.array([lang] * n, pa.string()))
            rows["size"].append(pa.array([size] * n, pa.int32()))
            rows["n"].append(pa.array(counts, pa.int64()))
            rows["word"].append(pa.nulls(n, pa.string()) if words is None else pa.array(words, pa.string()))

        named: dict[int, bytes] = {}
        langs = packets["lang"].to_pylist()
        for lang in sorted(set(langs)):
            mine = packets.filter(pa.array([x == lang for x in langs]))
            totals: dict[bytes, int] = {}
            for payload in mine["payload"].to_pylist():
                words, n = _unpack(payload)[:2]
                for w, k in zip(words, n.tolist()):
                    totals[w] = totals.get(w, 0) + k
            for w in totals:
                if named.setdefault(_number(w, seed), w) != w:
                    add(lang, -1, [], np.zeros(1, np.int64))
            often = [w for w, k in totals.items() if k >= least]
            add(lang, 0, [], np.array([sum(totals.values())], np.int64))
            add(lang, 1, [np.array([_number(w, seed) for w in often], np.uint64)],
                np.array([totals[w] for w in often], np.int64), [w.decode() for w in often])
            for size in (2, 3):  # one after the other, for less memory
                unpacked = [_unpack(payload)[2 * size - 2:2 * size] for payload in mine["payload"].to_pylist()]
                columns = [np.concatenate(c) for c in zip(*(columns for columns, _ in unpacked))]
                counts = np.concatenate([counts for _, counts in unpacked])
                del unpacked
                merged = _counted(columns, counts)
                keep = merged.counts >= least
                add(lang, size, [c[keep] for c in merged.words], merged.counts[keep])
        return pa.table({c: pa.concat_arrays(v) for c, v in rows.items()})
    return job


def stripes(docs: DataFrame, least: int = LEAST, number: int = 0) -> DataFrame:
    """(lang, size, x, y, z, n, word): words, pairs and triples with frequency ``least`` or more, the words by
    their numbers, and (size 0) parts of the words of each language."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # as few as memory allows: a packet has a dictionary, so small ones cost more
    buckets = min(MOST_BUCKETS, max(size // BUCKET_BYTES, 2 * spark.sparkContext.defaultParallelism))
    for seed in range(number, number + 100):
        found = materialized(texts.mapInArrow(_count(buckets, seed), PACKETS).groupBy("bucket").applyInArrow(
            _merge(least, seed), FOUND), "stripes")
        if found.where("size = -1").isEmpty():
            return found
    raise ValueError("words cannot be told apart by their numbers")


def _score(a: Column, left: Column, right: Column) -> Column:
    whole = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", whole(a) * whole(a) * F.lit(1_000_000).cast("decimal(7,0)"), whole(left) * whole(right))


def collocations(docs: DataFrame, least: int = LEAST, subsumed: int = SUBSUMED, most: int = MOST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``most`` phrases of each language."""
    found = stripes(docs, least)
    total = found.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    word = lambda at, name: found.where("size = 1").select(
        "lang", F.col("x").alias(at), F.col("n").alias(name), F.col("word").alias(f"word_{at}"))
    pair = lambda a, b, name: found.where("size = 2").select(
        "lang", F.col("x").alias(a), F.col("y").alias(b), F.col("n").alias(name))
    triples = found.where("size = 3").select("lang", "x", "y", "z", F.col("n").alias("a"))
    longer = (triples.select("lang", "x", "y", "a").unionByName(
        triples.select("lang", F.col("y").alias("x"), F.col("z").alias("y"), "a"))
        .groupBy("lang", "x", "y").agg(F.max("a").alias("longest")))
    twos = (pair("x", "y", "a").join(longer, ["lang", "x", "y"], "left")
            .where(f"longest is null or 100 * longest < {subsumed} * a")
            .join(word("x", "l"), ["lang", "x"]).join(word("y", "r"), ["lang", "y"])
            .select("lang", F.concat_ws(" ", "word_x", "word_y").alias("phrase"), "a", "l", "r",
                    _score(F.col("a"), F.col("l"), F.col("r")).alias("score")))
    known = (triples.join(pair("x", "y", "f_xy"), ["lang", "x", "y"]).join(pair("y", "z", "f_yz"), ["lang", "y", "z"])
             .join(word("x", "f_x"), ["lang", "x"]).join(word("z", "f_z"), ["lang", "z"])
             .join(word("y", "f_y"), ["lang", "y"]))
    first, second = _score(F.col("a"), F.col("f_x"), F.col("f_yz")), _score(F.col("a"), F.col("f_xy"), F.col("f_z"))
    cut = F.when(first <= second, F.struct(F.col("f_x").alias("l"), F.col("f_yz").alias("r"), first.alias("score"))).otherwise(
        F.struct(F.col("f_xy").alias("l"), F.col("f_z").alias("r"), second.alias("score")))
    threes = known.select("lang", F.concat_ws(" ", "word_x", "word_y", "word_z").alias("phrase"), "a", cut.alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    every = materialized(twos.unionByName(threes), "phrases")
    ranked = places(every, "lang", [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], "ranked-phrases").where(
        F.col("place") < most)
    return ranked.join(total, "lang").select(
        "lang", (F.col("place") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same rows in SQL.
ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
phrases AS (
  SELECT lang, unnest(w) AS p, 1 AS size FROM words
  UNION ALL
  SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 FROM words WHERE len(w) > 1
  UNION ALL
  SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3
  FROM words WHERE len(w) > 2),
f AS (SELECT lang, p, size, count(*) AS a FROM phrases GROUP BY 1, 2, 3),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY 1),
candidates AS (SELECT lang, p, size, a, string_split(p, ' ') AS w FROM f WHERE size > 1 AND a >= 10),
longer AS (
  SELECT lang, part, max(a) AS longest FROM (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part, a FROM candidates WHERE size = 3) GROUP BY 1, 2),
cuts AS (
  SELECT c.lang, c.p, c.a, k, x.a AS l, y.a AS r,
    CAST(1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.p = array_to_string(c.w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.p = array_to_string(c.w[k + 1:], ' ')
  LEFT JOIN longer g ON g.lang = c.lang AND g.part = c.p
  WHERE g.longest IS NULL OR 100 * g.longest < 50 * c.a),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM lowest) JOIN n USING (lang)
WHERE rank <= 2000"""
