"""Exact owners, collocations and the Merkle manifest against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import brute
from searchshift.llm import collocations, exact_dedup, merkle, near_dup
from searchshift.llm.ranked import places


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_owners(rows):
    """As a multiset: of rows with the least id any one stays."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc)
    out = []
    for text, docs in groups.items():
        docs.sort(key=lambda d: (d is None, d or 0))
        out += [(d, docs[0], len(docs), k == 0, sha(text)) for k, d in enumerate(docs)]
    return out


@pytest.mark.parametrize("trie_bytes", [exact_dedup.TRIE_BYTES, 20_000])
def test_owners_against_brute_force(odd_docs, odd_rows, trie_bytes):
    got = exact_dedup.owners(odd_docs, trie_bytes).collect()
    assert plain(got) == plain(brute_owners(odd_rows))
    assert sum(not r.kept for r in got) > 3


def test_owners_of_nothing(no_docs):
    assert exact_dedup.owners(no_docs).collect() == []


def test_distinct_texts(odd_docs, odd_rows):
    got = exact_dedup.distinct_texts(odd_docs, 50_000).collect()
    want = {(k, n, t) for _, k, n, _, t in brute_owners(odd_rows)}
    assert len(got) == len(want) and {(r.doc_id, r.group_size, sha(r.text)) for r in got} == want


def test_hot_copies_move_once_a_task(spark):
    rows = [(k, "the  same text " * 50 if k % 3 else f"text {k}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    _, nodes, ways = exact_dedup._owners(docs, exact_dedup.TRIE_BYTES, False)
    assert nodes.count() == 1001 and ways.count() <= 1000 + 8 * 2
    assert plain(exact_dedup.owners(docs).collect()) == plain(brute_owners(rows))


def test_trie_keeps_prefixes_apart():
    trie = exact_dedup.Trie()
    texts = [b"", b"a", b"ab", b"abc", b"abd", b"b", b"abc", b"", b"x" * 1000, b"x" * 999 + b"y", b"x" * 500]
    found = [trie.insert(t, k, (0, k, k), 1) for k, t in enumerate(texts)]
    assert found == [0, 1, 2, 3, 4, 5, 3, 0, 8, 9, 10]
    rng = random.Random(1)
    pool = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(40))) for _ in range(3000)]
    trie, first = exact_dedup.Trie(), {}
    for k, t in enumerate(pool):
        assert trie.insert(t, k, (0, k, k), 1) == first.setdefault(t, k)
    assert {o[3]: o[2] for o, _ in trie.rest()} == dict(Counter(pool))
    assert trie.bytes == sum(map(len, set(pool)))


def brute_collocations(rows, least, subsumed, most):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                f[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            if any(100 * b >= subsumed * a for q, b in found.items()
                   if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))):
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def chatter(seed, n):
    rng = random.Random(seed)
    words = "New York CITY hall of the é ß a b".split()
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " "])
                           for _ in range(rng.randrange(60)))
    return [(rng.choice(["en", "de", None, "und"]), rng.choice([None, "", text(), text(), text() + " New York City hall"]))
            for _ in range(n)]


def test_collocations_against_brute_force(spark):
    rows = chatter(5, 300) + [("xx", "one two three " * 2000), ("yy", "rare pair"), ("zz", None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n long, bucket string").repartition(5)
    got = collocations.collocations(docs, most=40).collect()
    want = brute_collocations(rows, 10, 50, 40)
    assert plain(got) == plain(want) and len(want) > 60


def test_collocations_of_odd_rows(odd_docs, odd_rows):
    got = collocations.collocations(odd_docs, least=3).collect()
    assert plain(got) == plain(brute_collocations([(None if d == 7 else "xx", t) for d, t in odd_rows], 3, 50, 2000))


def test_collocations_of_nothing(no_docs):
    assert collocations.collocations(no_docs).collect() == []


def test_colliding_numbers_change_the_seed(spark, monkeypatch):
    rows = chatter(6, 60)
    docs = spark.createDataFrame(rows, "lang string, text string")
    number, seen = collocations._number, []
    merged = collocations._merge

    def once(least, seed):
        seen.append(seed)
        job = merged(least, seed)

        def job_with_collision(packets):
            out = job(packets)
            if seed:
                return out
            sizes = [-1] * out.num_rows
            return out.set_column(1, "size", [sizes]).cast(out.schema)
        return job_with_collision
    monkeypatch.setattr(collocations, "_merge", once)
    got = collocations.collocations(docs).collect()
    assert seen == [0, 1] and number is collocations._number
    assert plain(got) == plain(brute_collocations(rows, 10, 50, 2000))


def test_counts_wider_than_a_packed_key():
    import numpy as np
    ids = np.array([0, 1, 2, 9, 1, 2, 0, 1, 2], np.int64)
    narrow, wide = (collocations._phrases(ids, 9, many, 3) for many in (10, 1 << 22))
    assert [w.tolist() for w in narrow.words] == [w.tolist() for w in wide.words]
    assert narrow.counts.tolist() == wide.counts.tolist()


def brute_manifest(rows, tampered):
    """rows: doc_id, source, lang, n_chars, text."""
    cell = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(cell, r)))

    def tree(hashes):
        """Root, and per leaf the (sibling or None, on the left) of every level."""
        paths, at, level = [[] for _ in hashes], list(range(len(hashes))), hashes
        while len(level) > 1:
            for k, path in enumerate(paths):
                other = at[k] ^ 1
                path.append((level[other] if other < len(level) else None, at[k] % 2 == 1))
                at[k] //= 2
            level = [sha("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
        return level[0], paths

    def up(h, path):
        for other, left in path:
            h = sha(h if other is None else other + h if left else h + other)
        return h

    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    ordered = {x: sorted(by_lang[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: tree([leaf(r) for r in ordered[x]]) for x in langs}
    root, tops = tree([trees[x][0] for x in langs]) if langs else (None, [])
    out = []
    for x, top in zip(langs, tops):
        subroot, paths = trees[x]
        for r, path in zip(ordered[x], paths):
            found = list(r)
            if r[0] is not None and tampered(r[0]) and r[3] is not None:
                found[3] += 1
            folded = up(leaf(found), path + top)
            proof = sha("".join(s for s, _ in path + top if s is not None))
            out.append((r[0], leaf(r), subroot, root, proof, folded, folded == root))
    return out


SEVENTH = lambda d: zlib.crc32(str(d).encode()) % 7 == 0


def manifest(docs):
    return merkle.manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0,
                           {"n_chars": F.col("n_chars").cast("decimal(20,0)") + F.lit(1).cast("decimal(20,0)")})


def records(counts, seed=4):
    rng = random.Random(seed)
    rows = []
    for lang, n in counts.items():
        for _ in range(n):
            rows.append((rng.choice([None, *range(4000)]), rng.choice([None, "web", "ü"]), lang,
                         rng.choice([None, 3, 2**63 - 1]), rng.choice([None, "", "text", "é" * 50])))
    rows += rows[:3]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, place long, h string"


@pytest.mark.parametrize("counts", [{"en": 1}, {None: 2}, {"en": 3, None: 1, "": 1},
                                    {"en": 700, "de": 256, "é": 257, "z": 1, None: 5}])
def test_manifest_against_brute_force(spark, counts):
    rows = records(counts)
    docs = spark.createDataFrame([(*r, "t", 1, "h") for r in rows], SCHEMA).repartition(3)
    got = manifest(docs).collect()
    assert plain(got) == plain(brute_manifest(rows, SEVENTH))


def test_manifest_of_many_languages(spark):
    rows = records({f"l{k}": 1 + k % 3 for k in range(300)})
    docs = spark.createDataFrame([(*r, "t", 1, "h") for r in rows], SCHEMA)
    got = manifest(docs).collect()
    assert plain(got) == plain(brute_manifest(rows, SEVENTH))
    assert any(not r.verified for r in got)


def test_manifest_by_joins_of_every_kind(spark, monkeypatch):
    """Levels and parents too large to be sent give the same rows."""
    monkeypatch.setattr(merkle, "MOST_BYTES", 0)
    monkeypatch.setattr("searchshift.llm.ranked.MOST_SENT", 0)
    rows = records({"en": 300, "de": 40})
    docs = spark.createDataFrame([(*r, "t", 1, "h") for r in rows], SCHEMA)
    assert plain(manifest(docs).collect()) == plain(brute_manifest(rows, SEVENTH))


def test_manifest_of_nothing(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_places_in_hot_groups(spark):
    rows = [("hot" if k % 5 else f"g{k % 10}", k % 7) for k in range(2000)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = places(df, "g", [F.col("v").desc()], "t").collect()
    groups = defaultdict(list)
    for r in got:
        groups[r.g].append((r.place, r.v, r["size"]))
    for g, found in groups.items():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found))) and {s for _, _, s in found} == {len(found)}
        assert [v for _, v, _ in found] == sorted((v for _, v, _ in found), reverse=True)


def family(n, seed, shared):
    """Texts around one that is not among them, every third with edits that others have too."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for k in range(n):
        text = list(base)
        for i in rng.sample(range(90), rng.randrange(9)):
            text[i] = f"e{i % shared}" if k % 3 else f"e{k}x{i}"
        rows.append((k, " ".join(text)))
    return rows


@pytest.mark.parametrize("longest", [2, 1024])
def test_links_of_a_family_by_differences(spark, monkeypatch, longest):
    """Short lists are compared, longer ones become groups of their own; the links are the same."""
    monkeypatch.setattr(near_dup, "SHORT_LIST", longest)
    rows = family(60, 2, 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute.near_duplicates(rows)
    assert plain(near_dup.near_duplicates(docs).collect()) == plain(want)
    assert 3 < sum(w[3] for w in want) < 55


def test_repeated_ids_are_tested_once(spark, monkeypatch):
    """Hundreds of rows with two ids and two texts are two classes and one test."""
    text = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(text)), (2, " ".join([*text, "tail"]))] * 200 + [(1, "another text of its own")]
    pairs, compared = [], near_dup._verified

    def counted(p, *rest):
        pairs.append(p.count())
        return compared(p, *rest)
    monkeypatch.setattr(near_dup, "_verified", counted)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sum(pairs) == 1
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.text for r in near_dup.one_of_each(docs).collect()) == sorted({t for d, t in rows if d == 1})


def test_words_of_a_run_are_a_parameter(spark):
    text = [f"w{i}" for i in range(100)]
    other = [*text[:30], "x", *text[31:60], "y", *text[61:]]  # 8 of 97 runs of four go, 10 of 96 of five
    docs = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(other))], "doc_id long, text string")
    n = {w: [(r.n_shingles, r.kept) for r in near_dup.near_duplicates(docs, w).orderBy("doc_id").collect()] for w in (4, 5, 6)}
    assert n == {4: [(97, True), (97, False)], 5: [(96, True), (96, False)], 6: [(95, True), (95, True)]}
