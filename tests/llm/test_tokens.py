import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from searchshift.llm import bpe, token_store
from searchshift.llm.tokens import Tokens, slices
from searchshift.session import scratch_dir


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def test_ids_are_the_librarys(vocabulary):
    rng = random.Random(1)
    texts = [None, "", "  ", "It's we'll Don'T", "a<|endoftext|>b <|startoftext|>", "İ ŉ ſ Ÿ ß ×÷ ² ½ Ⅷ ٣ é ́x a b \x1c \x85z",
             "中文字 각 ΑΣ ΣΑΣ 😀👍🏽", "x" * 5000, "a\x00b _ __a_ 1a2", "ﬁ Å Ω Ǆ", "¡hola! «x» º ª µ"]
    texts += ["".join(rng.choice("abc'sSrRe  .,!1²éÉÀıİ́<|>endoftext \n\t\xa0 ſßµºΣςσ") for _ in range(rng.randrange(30)))
              for _ in range(1500)]
    plain = library(vocabulary)
    for most in (10**6, 50):
        ids, bounds = Tokens(vocabulary, most).encode(pa.array(texts, pa.string()))
        for k, text in enumerate(texts):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_slices_cover_all_rows():
    column = pa.array(["a" * 10, None, "b" * 100, "", "c" * 5], pa.string())
    assert slices(column, 20) == [(0, 2), (2, 1), (3, 2)]
    assert slices(column.slice(0, 0)) == []


def expected(rows, path, end=()):
    plain = library(path)
    return [(d, plain.encode(t or "", add_special_tokens=False).ids + list(end)) for d, t in rows]


def test_chunk_reuse_against_library(odd_docs, odd_rows, vocabulary):
    plain = library(vocabulary)
    want = sorted(((d, len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(),
                    hashlib.sha256(plain.decode(i, skip_special_tokens=False).encode()).hexdigest())
                   for d, i in expected(odd_rows, vocabulary)), key=repr)
    got = bpe.digests(odd_docs, vocabulary).collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_chunk_reuse_gives_ids(odd_docs, odd_rows, vocabulary):
    got = sorted(((r.doc_id, r.ids) for r in bpe.encode(odd_docs, vocabulary).collect()), key=repr)
    assert got == sorted(expected(odd_rows, vocabulary), key=repr)


def test_chunks_of_shared_passages_are_cut_alike():
    rng = random.Random(4)
    passage = " ".join(f"w{rng.randrange(10**6)}" for _ in range(2000)).encode()
    chunks = bpe.Chunked([b"head " + passage, b"quite another beginning " + passage + b" tail"])
    first, second = ({tuple(h) for h in chunks.digests[chunks.text_of == k].tolist()} for k in (0, 1))
    assert len(first & second) > 0.7 * len(first)


def test_store_round_trip(spark, odd_docs, odd_rows, vocabulary):
    path = scratch_dir(spark, "store")
    token_store.write_tokens(odd_docs, path, vocabulary, 2)
    got = token_store.read_digests(spark, path).collect()
    want = expected(odd_rows, vocabulary, [2])
    total = sum(len(i) for _, i in want)
    spans = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert spans[0][0] == 0 and spans[-1][1] == total and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(
        ((d, len(i), crc(i)) for d, i in want), key=repr)
    known = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert known[:2] == [None, None] and known[2:] == sorted(known[2:])
    page = spark.read.parquet(path).where("n_ids > 1100").first().asDict()
    assert (token_store.read_block(page, 1) == token_store.read_ids(page)[1024:2048]).all()


def test_nothing_to_encode(spark, no_docs, vocabulary):
    assert bpe.digests(no_docs, vocabulary).collect() == []
    path = scratch_dir(spark, "store")
    token_store.write_tokens(no_docs, path, vocabulary, 2)
    assert token_store.read_digests(spark, path).collect() == []
