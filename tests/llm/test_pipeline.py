import hashlib

import brute
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from searchshift.llm import pii, quality, token_store
from searchshift.llm.queries import DEMONSTRATION_KEY, QUERIES


def digest(ids, plain):
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(plain.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_pipeline_against_brute_force(spark, small, vocabulary):
    plain = Tokenizer.from_file(vocabulary)
    read = lambda t: [r.asDict() for r in spark.read.parquet(f"{small}/{t}.parquet").collect()]
    docs, labels, items = read("documents"), read("labels"), read("benchmark")
    known = {r["doc_id"]: r["quality"] for r in labels}
    kept = brute.quality([(d["doc_id"], d["text"], d["lang"]) for d in docs], known, quality.CUTOFFS, 0.02, 0.05)
    docs = [d for d, k in zip(docs, kept) if k]
    alone = brute.near_duplicates([(d["doc_id"], d["text"]) for d in docs], 5)
    docs = [d for d, r in zip(docs, alone) if r[3]]
    dirty = {d for d, _ in brute.hits([(d["doc_id"], d["text"]) for d in docs], [(r["item_id"], r["text"]) for r in items])}
    docs = [d for d in docs if d["doc_id"] not in dirty]
    texts = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string")
    want = sorted((r.doc_id, *digest(plain.encode(r.text, add_special_tokens=False).ids, plain))
                  for r in pii.pseudonymize(texts, DEMONSTRATION_KEY).collect())
    got = corpus_pipeline.run(spark, small)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_odd_documents(spark, small, odd_docs, no_docs, stage):
    made = stage(spark, odd_docs, small)
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert made.columns == odd_docs.columns
    assert made.count() <= odd_docs.count()
    assert stage(spark, no_docs, small).collect() == []


def test_lengths_follow_pseudonyms(spark, small):
    docs = spark.createDataFrame([(1, "mail me@example.com now", 23), (2, None, 5)], "doc_id long, text string, n_chars int")
    got = corpus_pipeline.pii_stage(spark, docs, small).orderBy("doc_id").collect()
    assert got[0].n_chars == len(got[0].text) != 23 and got[1].n_chars == 5


def test_registered_queries_without_sql(spark, small, vocabulary):
    """The token store and the encoder over the whole table."""
    plain = Tokenizer.from_file(vocabulary)
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    ids = {d.doc_id: plain.encode(d.text or "", add_special_tokens=False).ids for d in docs}
    got = QUERIES["op9_bpe_chunk_reuse"](spark, small).collect()
    assert sorted(map(tuple, got)) == sorted((d, *digest(i, plain)) for d, i in ids.items())
    stored = QUERIES["op8_token_store"](spark, small).collect()
    at = 0
    for r in sorted(stored, key=lambda r: r.doc_id):
        assert (r.start, r.n_tokens) == (at, len(ids[r.doc_id]) + 1)
        at += r.n_tokens
    assert token_store.PAGES and len(stored) == len(docs)
    rules = QUERIES["op6_quality_rules"](spark, small).collect()
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rules) == sorted(
        (d.doc_id, *brute.counts(d.text), brute.base_failed(d.text)) for d in docs)
    found = QUERIES["op1_pii_pseudonyms"](spark, small).agg(F.count("*"), F.sum(F.size("kinds"))).first()
    assert found[0] == len(docs) and found[1] > 0
