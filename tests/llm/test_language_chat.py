import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from searchshift.llm import chat, language
from searchshift.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def model(spark, small):
    return language.train(spark.read.parquet(f"{small}/documents.parquet"))


def brute_scores(text, langs, weights):
    data = (text or "").lower().encode()
    out = [0.0] * len(langs)
    for i in range(len(data) - 2):
        h = ((data[i] | data[i + 1] << 8 | data[i + 2] << 16) * 0x9E3779B1) % 2**32 >> (32 - language.BUCKET_BITS)
        for k in range(len(langs)):
            out[k] += float(np.float32(weights[k][h]))
    return [language.TEMPER * x for x in out]


def softmax(x):
    e = [math.exp(v - max(x)) for v in x]
    return [v / sum(e) for v in e]


def brute(rows, langs, weights, strength):
    """lang and confidence of (key, host, declared, text) rows."""
    n = len(langs)
    scores = [brute_scores(t, langs, weights) for *_, t in rows]
    said = ["" if not d else d if d in langs else "?" for _, _, d, _ in rows]
    table, totals = defaultdict(lambda: [0.0] * n), [0.0] * n
    for s, score in zip(said, scores):
        for k, q in enumerate(softmax(score)):
            table[s][k] += q
            totals[k] += q
    common = [(t + 1) / (sum(totals) + n) for t in totals]
    likely = [[x + math.log((table[s][k] + 1) / (totals[k] + n + 2)) for k, x in enumerate(score)] for s, score in zip(said, scores)]
    first = [softmax([x + math.log(p) for x, p in zip(row, common)]) for row in likely]
    levels = [lambda h: h.rsplit(".", 1)[-1], lambda h: ".".join(h.split(".")[-2:]), lambda h: h]
    sums = [defaultdict(lambda: [0.0] * n) for _ in levels]
    for (_, host, _, _), q in zip(rows, first):
        for level, total in zip(levels, sums):
            if host:
                total[level(host)] = [a + b for a, b in zip(total[level(host)], q)]
    out = []
    for (key, host, _, _), q, row in zip(rows, first, likely):
        prior = common
        for level, total in zip(levels, sums):
            if host:
                rest = [max(a - b, 0) for a, b in zip(total[level(host)], q)]
                prior = [(r + strength * p) / (sum(rest) + strength) for r, p in zip(rest, prior)]
        post = softmax([x + math.log(p) for x, p in zip(row, prior)])
        out.append((key, langs[post.index(max(post))], max(post)))
    return out


def test_fusion_against_brute_force(spark, model):
    langs, weights = model
    rows = [(1, "a.x.de", "de", "Der Hund und die Katze"), (2, "a.x.de", "", "ein"), (3, "a.x.de", "", None), (4, "b.x.de", "en", ""),
            (5, "", "", "The thing and the other"), (6, None, "xx", "La chose et les autres"), (7, "c.com", "fr", "x"),
            (8, "com", None, "el perro y la casa"), (8, "com", None, "el perro y la casa"), (None, "c.com", "fr", "ab"),
            (10, "c.com", "fr", "de la maison " * 3000)]
    table = spark.createDataFrame(rows, "page_id long, host string, declared string, text string").repartition(2)
    got = sorted(map(tuple, language.identify(table, model).collect()), key=repr)
    want = sorted(brute(rows, langs, weights, language.STRENGTH), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-6)


def test_held_out_accuracy(spark, small):
    """Trained on even documents, judged on odd ones and on pages."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = language.train(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1")
    plain = held.select("doc_id", F.lit(None).cast("string").alias("host"), F.lit("").alias("declared"), "text")
    right = language.identify(plain, model, key="doc_id").join(held.select("doc_id", F.col("lang").alias("true")), "doc_id")
    assert right.where("lang = `true`").count() >= 0.95 * right.count() > 0
    pages = spark.read.parquet(f"{small}/pages.parquet")
    true = pages.select("page_id", F.regexp_extract("url", "/(..)/", 1).alias("true"))
    judged = language.identify(language.evidence(pages), model).join(true, "page_id")
    assert judged.where("lang = `true`").count() >= 0.95 * judged.count() > 0


def test_markup(spark):
    pages = ['<html lang="en-GB"><style>p{}</style><p>Hi&nbsp;there<!-- no --></p><script>x</script>', "<HTML class=a LANG='FR'>a",
             "<html>b", None, "", "plain lang=de", "<p lang=es>c</p>"]
    rows = spark.createDataFrame([(k, "http://h.x/", p) for k, p in enumerate(pages)], "page_id int, url string, html string")
    got = language.evidence(rows).orderBy("page_id").collect()
    assert [r.declared for r in got] == ["en", "fr", "", "", "", "", ""]
    assert got[0].text.split() == ["Hi", "there"] and got[3].text is None


def test_no_labels_no_rows(spark, model, no_docs):
    nothing = language.train(no_docs)
    rows = spark.createDataFrame([(1, "a.b", "en", "text")], "page_id long, host string, declared string, text string")
    assert [tuple(r) for r in language.identify(rows, nothing).collect()] == [(1, None, None)]
    assert language.identify(rows.limit(0), model).collect() == []


def dialogues(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello ann"), (1, 3, "cy", ""), (1, 70, "ann", "late"),
            (1, 3, "bob", "same turn"), (1, None, "bob", "no turn"), (2, 0, "system", "alone"), (3, 0, None, "no role"),
            (3, 0, None, "no role"), (None, 1, "ann", "no conversation"), (4, 1, "ann", None), (4, -1, "é😀", "ünï😀")]
    rows += [(5, k, ("user", "assistant")[k % 2], f"t{k}") for k in range(300)]
    return [(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, part string, speaker string"


def test_rotation_against_sql(spark):
    rows, schema = dialogues(spark)
    views = chat.rotate(spark.createDataFrame(rows, schema).repartition(3)).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR, part VARCHAR, speaker VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?, ?, ?)", rows)
    want = con.execute(ORACLES["op5_perspective_rotation"]).fetchall()
    shown = [(*r[:6], " ".join(f"{s.start}+{s.length}" for s in r.spans)) for r in views]
    assert sorted(shown) == sorted(want)
    for r in views:
        for s in r.spans:
            assert r.text[s.start:s.start + s.length].endswith(chat.CLOSE)
        assert sum(s.length for s in r.spans) == r.n_target
    whole = [v for v in views if v.conv_id == 1 and v.speaker == "ann" and v.part == 0][0].text
    assert whole.startswith("<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|user name=bob|>\nhello ann<|end|>\n")
    assert len([v for v in views if v.conv_id == 5 and v.speaker == "user"]) == 5


def test_rotation_of_nothing(spark):
    rows, schema = dialogues(spark)
    assert chat.rotate(spark.createDataFrame(rows, schema).limit(0)).collect() == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_queries_against_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = QUERIES[name](spark, small)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted((str(tuple(r)) for r in df.select(*columns).collect())) == sorted(str(r) for r in result.fetchall())
