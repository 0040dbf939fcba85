import random

import brute
import pytest
from pyspark.sql import functions as F

from searchshift.llm import decontaminate, pii, quality, url_filter

CUTS = {"symbols": (0.01, 0.1), "repeated_lines": (0.1, 0.5), "repeated_words": (0.1, 0.4), "capitals": (0.1, 0.5),
        "exclamations": (0.01, 0.2), "long_words": (5.0, 9.0)}


def test_counts_against_brute_force(odd_docs, odd_rows):
    got = odd_docs.select("doc_id", quality.signals(F.col("text")).alias("s")).select("doc_id", "s.*").collect()
    want = [(d, *brute.counts(t), brute.base_failed(t), tuple(brute.rates(t).values())) for d, t in odd_rows]
    assert sorted(((*r[:-1], tuple(r[-1])) for r in got), key=repr) == sorted(want, key=repr)


def test_counts_of_special_texts(spark):
    texts = ["a a a a", "a b c a b c", "x\nx\n\n \ny\nx", "#*$%&|<> @", "\x0b\x0c\r\t ", "a\x1cb \x85 é\U0001f600", "a b\u2003c"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = rows.select("text", quality.signals(F.col("text")).alias("s")).select("text", "s.*").collect()
    assert [tuple(r)[:6] for r in got] == [(t, *brute.counts(t)) for t in texts]


def test_binomial_tail(spark):
    cases = [(k, n) for n in (1, 5, 50, 1000) for k in range(0, min(n, 60) + 1)]
    rows = spark.createDataFrame(cases, "k long, n long")
    for rate in (0.003, 0.05, 0.3):
        for r in rows.select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), rate).alias("p")).collect():
            assert r.p == pytest.approx(brute.tail(r.k, r.n, rate), rel=1e-9, abs=1e-300)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(700):
        text = " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6))) for _ in range(70))
        bad = k % 7 == 0
        if bad:
            text = text.replace("a", "#") if k % 2 else text.upper()
        rows.append((k, text, "en" if k % 3 else None))
        labels.append((k, 0 if bad else 1, 0))
    rows += [(9000, None, "en"), (9001, "", "zz"), (None, rows[1][1], "en"), (5, rows[5][1], "en"), (9002, rows[2][1], "zz")]
    labels += [(2, 0, 0), (None, 1, 0), (3, None, 0), (10**6, 1, 1)]
    return rows, labels


def test_verdicts_against_brute_force(spark, labelled):
    rows, labels = labelled
    docs = spark.createDataFrame([(*r, "s", "kept") for r in rows], "doc_id long, text string, lang string, s string, kept string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {}
    for d, q, _ in labels:
        found.setdefault(d, []).append(q)
    known_as = lambda q: 1 if q and min(q) == 1 else 0 if q and max(q) == 0 else "neither"
    judged = {d: known_as([x for x in q if x is not None]) for d, q in found.items() if d is not None}
    limits = dict(max_false_rejection=0.3, confidence_loss=0.2, cutoffs=CUTS)
    want = brute.quality(rows, judged, CUTS, 0.3, 0.2)
    got = quality.quality_rules(docs, known, **limits).select("doc_id", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], k) for r, k in zip(rows, want)), key=repr)
    assert 60 < sum(not k for k in want) < 140
    stayed = quality.keep_good(docs, known, **limits)
    assert stayed.columns == docs.columns
    plan = stayed._jdf.queryExecution().optimizedPlan().toString()  # texts are judged before, in the only pass
    assert "regexp" not in plan and "split(" not in plan and "translate" not in plan
    assert sorted((r.doc_id for r in stayed.collect()), key=repr) == sorted((r[0] for r, k in zip(rows, want) if k), key=repr)


def test_quality_without_labels_or_documents(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality_rules(odd_docs, none).select("s.base_failed", "kept").collect()
    assert got and all(r.kept != r.base_failed for r in got)
    assert quality.quality_rules(no_docs, none).collect() == []


@pytest.fixture(scope="module")
def leaks():
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    items = [(k, " ".join(fresh(rng.randint(5, 60)))) for k in range(30)]
    items += [(3, items[3][1]), (4, " ".join(fresh(20))), (50, None), (51, ""), (52, "only four words here"), (None, " ".join(fresh(12)))]
    docs = [(k, " ".join(fresh(rng.randint(1, 400)))) for k in range(60)]
    for k in range(60, 160):
        item = items[rng.randrange(len(items))][1] or ""
        w = item.split()
        for _ in range(rng.randrange(3)):
            if w:
                w[rng.randrange(len(w))] = "changed"
        docs.append((k, " ".join(fresh(100)) + ", " + " ".join(w).upper() + "! " + " ".join(fresh(rng.choice([3, 3000])))))
    docs += [(None, items[0][1]), (7, items[1][1]), (7, items[1][1]), (8, None), (8, items[2][1] + " " + items[5][1]), (9, "")]
    return docs, items


def test_hits_against_brute_force(spark, leaks):
    docs, items = leaks
    d = spark.createDataFrame([(*r, "x", "y") for r in docs], "doc_id long, text string, doc string, run string").repartition(3)
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, item string")
    want = brute.hits(docs, items)
    for bound in (decontaminate.MAX_SIGNATURES, 0):  # signatures handed out, or joined
        got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in decontaminate.hits(d, i, max_signatures=bound).collect()}
        assert got == want
    assert len(want) > 60
    dirty = {k for k, text in docs if any((k, item) in want for item, _ in items)}
    clean = decontaminate.without_items(d, i)
    assert clean.columns == d.columns
    kept = [(r.doc_id, r.text) for r in clean.collect()]
    texts = {t for t in (x for _, x in docs) if any(brute.hits([(0, t)], items))}
    assert sorted(kept, key=repr) == sorted(((a, t) for a, t in docs if t not in texts), key=repr)
    assert {k for k, _ in docs} - {k for k, _ in kept} <= dirty


def test_hits_of_nothing(spark, odd_docs, no_docs, leaks):
    items = spark.createDataFrame(leaks[1], "item_id long, text string")
    assert decontaminate.hits(no_docs, items).collect() == []
    assert decontaminate.hits(odd_docs, items.limit(0)).collect() == []
    assert decontaminate.without_items(odd_docs, items.limit(0)).count() == odd_docs.count()


def pseudonyms(spark, texts, key="k", invert=False):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    made = rows.select("k", pii.pseudonyms(F.col("text"), F.lit(key), invert).alias("p")).orderBy("k")
    return [(r.p.text, r.p.kinds) for r in made.collect()]


def test_pseudonyms_keep_format_and_links(spark):
    texts = ["card 4845168114407329, 4845 1681 1440 7329; 4845-1681-1440-7329 not 4845168114407320",
             "Call +1 (743) 555-3824 or (743) 555-3824 now", "ip 227.5.221.1. not 300.1.2.3 nor 1.2.3.4.5",
             "on 2024-02-29, 29.02.2024 and 29/02/2024, never 2023-02-29", "ssn 078-05-1120 not 666-12-1234 or 900-11-2222",
             "DE89370400440532013000 = DE89 3704 0044 0532 0130 00, not DE88370400440532013000",
             "the.72@mail3.example.com THE.72@mail3.example.com.", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"###']
    got = pseudonyms(spark, texts)
    plain = brute.card("4845168114407329", "k")
    assert got[0][0] == (f"card {plain}, {plain[:4]} {plain[4:8]} {plain[8:12]} {plain[12:]}; "
                         f"{plain[:4]}-{plain[4:8]}-{plain[8:12]}-{plain[12:]} not 4845168114407320")
    assert brute.luhn(plain) and got[0][1] == ["card"] * 3
    phone = brute.permuted("7435553824", "k", "phone")
    shown = f"({phone[:3]}) {phone[3:6]}-{phone[6:]}"
    assert got[1][0] == f"Call +1 {shown} or {shown} now"
    a, b = brute.feistel(227 * 256 + 5, 221 * 256 + 1, 65536, 65536, "k", "ip")
    assert got[2][0] == f"ip {a // 256}.{a % 256}.{b // 256}.{b % 256}. not 300.1.2.3 nor 1.2.3.4.5"
    iso, dotted, slashed = got[3][0][3:13], got[3][0][15:25], got[3][0][30:40]
    assert dotted == ".".join(reversed(iso.split("-"))) and slashed == dotted.replace(".", "/")
    assert got[3][0].endswith("never 2023-02-29") and iso != "2024-02-29"
    assert got[4][1] == ["ssn"] and got[4][0].endswith("not 666-12-1234 or 900-11-2222")
    iban = got[5][0][:22]
    letters = "".join(str(int(c, 36)) for c in iban[4:] + iban[:4])
    assert int(letters) % 97 == 1 and got[5][0].split(" = ")[1].split(",")[0].replace(" ", "") == iban
    assert got[6][1] == ["mail", "mail"] and "mail3" not in got[6][0]
    assert got[6][0].split()[0] + "." == got[6][0].split()[1]
    assert got[7][1] == ["secret"] and len(got[7][0]) == len(texts[7])
    back = pseudonyms(spark, [g[0] for g in got[:6]], invert=True)
    assert [b[0] for b in back] == texts[:6]
    other = pseudonyms(spark, texts, key="another")
    assert all(g[0] != o[0] for g, o in zip(got, other))


def test_networks_are_permutations(spark):
    for left, right in ((17, 4297), (10, 10), (1, 7)):
        pairs = spark.range(left * right).select(F.floor(F.col("id") / right).alias("l"), (F.col("id") % right).alias("r"))
        out = pairs.select(pii.feistel(F.col("l"), F.col("r"), F.lit(left), F.lit(right), F.lit("k"), "t").alias("p"))
        assert out.distinct().count() == left * right
        row = out.agg(F.max("p.l"), F.max("p.r"), F.min("p.l"), F.min("p.r")).first()
        assert tuple(row) == (left - 1, right - 1, 0, 0)


def test_pseudonyms_of_odd_texts(spark, odd_docs, no_docs):
    texts = [None, "", "a@b", "x" * 100_000 + "1", "1." * 50_000, "1 " * 50_000, "a.b" * 30_000 + "@c.d", "-" * 9 + "9" * 30, "@" * 1000]
    got = pseudonyms(spark, texts)
    assert [g[0] for g in got[:6]] == texts[:6] and got[0][1] == [] and got[6][1] == ["mail"]
    assert got[7][0] == texts[7] and got[8][0] == texts[8]
    made = pii.pseudonymize(odd_docs, "k", found="kinds")
    assert made.columns == [*odd_docs.columns, "kinds"]
    assert made.drop("kinds").exceptAll(odd_docs).count() == 0
    assert pii.pseudonymize(no_docs, "k").collect() == []


URLS = [None, "", "nothing", "http://", "http://com", "http://com/", "HTTPS://Example.COM/en/1?x#y", "http://www.example.com/en/",
        "http://a.www.example.com/en/q", "http://xexample.com/en/", "http://example.com/fr/en/", "http://m.net/es/",
        "http://m.net/es", "http://net/fr/x", "http://m.net/de/", "ftp://a://b.com/en/", "http://example.com:80/en/",
        "http://example.com./en/", "http://.com/", "http://user@example.com/en/", "http://éxample.COM/ÉN/", "://com/", "x?http://com/"]


def test_url_verdicts_against_brute_force(spark):
    rng = random.Random(2)
    urls = URLS + ["http://" + ".".join(rng.choice(["a", "b", "www", "example", "com", "net"]) for _ in range(rng.randint(1, 4)))
                   + rng.choice(["", "/", "/en/", "/en/x", "/es/"]) + rng.choice(["", "?q=/es/", "#top"]) for _ in range(400)]
    rules = [*url_filter.RULES, ("com", "/", "block"), ("b.com", "", "block"), ("a.b.com", "/en/", "allow"),
             ("com", "/en/x", "block"), ("-", "/", "block"), ("a", "/", "block"), (None, "/", "block")]
    known = [(h, p, v) for h, p, v in rules if h is not None]
    pages = spark.createDataFrame([(k if k % 50 else None, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    want = sorted(((k if k % 50 else None, *brute.judge(u, known, "ask")) for k, u in enumerate(urls)), key=repr)
    for bound in (url_filter.MAX_RULES, 2):  # by the sweep, by parents
        got = url_filter.judge(pages.repartition(3), table, default="ask", max_rules=bound).collect()
        assert sorted(map(tuple, got), key=repr) == want


def test_urls_without_rules_or_pages(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.b/c?d")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge(pages, rules).collect()] == [(1, "a.b", "/c", None, "allow")]
    assert url_filter.judge(pages.limit(0), rules).collect() == []
