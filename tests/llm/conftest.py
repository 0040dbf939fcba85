import os
import random

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no driver tables here")
    return SMALL


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text) rows with nulls, empty and long texts, copies, near copies and repeats."""
    rng = random.Random(7)
    vocabulary = [a + b for a in "ba ce di fo gu Ha Éi ño".split() for b in "la me ni po ru st tz".split()]
    fresh = lambda n: " ".join(rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(n))
    passage, long = fresh(70), fresh(30_000)
    base = fresh(200).split()
    rows = [(None, passage), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One"), (6, "two words"),
            (7, fresh(49)), (8, passage), (9, fresh(20) + "\n" + passage + "\t" + fresh(30)), (10, passage.upper()),
            (11, passage + " " + passage), (12, long), (13, long), (14, fresh(10) + " " + long[:3000]),
            (15, "a " * 400), (16, "a " * 300), (17, "x" * 50_000), (18, passage), (18, passage), (19, fresh(120)),
            (19, passage + " tail"), (20, "<|endoftext|> it's 3.5² İstanbul ΑΣ\x00é 中文 😀 "), (21, "'s 'll a'd"),
            (-5, fresh(60)), (2**40, passage)]
    for k in range(40):  # a family of near copies, neighbours alike and ends apart
        variant = list(base)
        for i in range(k, len(variant), 60 - k):
            variant[i] = f"new{k}"
        rows.append((100 + k, " ".join(variant)))
    rows += [(200 + k, fresh(rng.randrange(1, 300))) for k in range(30)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The rows with columns whose names the operators use inside."""
    names = "key id row n a b g h1 band s stratum run item doc kept _doc text_a".split()
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in names)
    return spark.createDataFrame([(d, t, None if d == 7 else "xx", *names) for d, t in odd_rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
