"""Quality rules whose cutoffs are certified on labelled documents.

Every signal is a number that grows as a text gets worse. Cutoffs are certified together: a
fixed sequence of steps takes signal after signal, each from its loosest cutoff to its
tightest, and every step rejects what any step so far rejects. Of the ``n`` documents of a
stratum that are labelled good ``k`` are rejected by a step, and it is certified if the exact
binomial tail P(X <= k), X ~ B(n, ``max_false_rejection``), is at most ``confidence_loss``
divided by the number of strata tested. As ``k`` only grows, the certified steps are the first
ones, and an error needs the first step that rejects too much to pass: one test per
stratum, whatever the number of signals and cutoffs. So with probability 1 - ``confidence_loss``
no stratum loses more than ``max_false_rejection`` of its good documents to all signals
together. Each signal takes its last certified cutoff, or none if the sequence ends before it.

Signals are in order of how much larger a share of the documents labelled bad lies above a cutoff than
of those without a label, at their best cutoff. Documents labelled good have no part in that, so
the order is fixed before they are looked at.

Strata whose labels are too few to certify anything even alone (149 at 2 % and 5 %) are not
tested and do not count; one of four tested strata needs 217 labels. A stratum with too few labels
certifies nothing and keeps what passes the base rules.

Defined results: a null text counts as empty; an empty text has no words and fails the
base rules; a null stratum counts as the stratum ''; repeated rows are judged each alone;
a document with contradicting labels is no good document; no labels, no cutoffs; signals equal in
order stay as they are listed; columns
of the input other than the ones read are passed through, also where a signal has the
same name, since the signals are kept in one struct.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from .expressions import BLANK, let, shingle_hashes, words_of

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50

#: Cutoffs tested for each signal.
CUTOFFS = {
    "symbols": (0.01, 0.02, 0.05, 0.1, 0.2, 0.4),
    "repeated_lines": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7),
    "repeated_words": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5),
    "capitals": (0.1, 0.2, 0.3, 0.5, 0.7, 0.9),
    "exclamations": (0.005, 0.01, 0.02, 0.05, 0.1, 0.2),
    "long_words": (8.0, 9.0, 10.0, 12.0, 15.0, 20.0),
}


def _covered(hashes: Column, size: int) -> Column:
    """Words covered by windows that occur at least twice; ``hashes`` are those of all windows."""
    def repeats(ordered: Column) -> Column:
        return F.exists(F.zip_with(F.slice(ordered, 1, F.size(ordered) - 1),
                                   F.slice(ordered, 2, F.size(ordered) - 1),
                                   lambda a, b: a == b), lambda same: same)

    def twins(placed: Column) -> Column:
        pairs = F.zip_with(F.slice(placed, 1, F.size(placed) - 1),
                           F.slice(placed, 2, F.size(placed) - 1),
                           lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))

    def union(starts: Column) -> Column:
        begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            starts, begin,
            lambda acc, i: F.struct((acc["n"] + i + size - F.greatest(i, acc["end"])).alias("n"),
                                    (i + size).alias("end")),
            lambda acc: acc["n"])

    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = (F.size(hashes) >= 2) & repeats(F.sort_array(hashes))
    return F.when(some, let(placed, lambda p: union(twins(p)))).otherwise(F.lit(0))


def signals(text: Column) -> Column:
    """Struct of counts and rates of one text; all of it, whatever its length."""
    text = F.coalesce(text, F.lit(""))
    word_lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")) != "")
    counts = F.struct(
        words_of(text).alias("words"),
        word_lines.alias("lines"),
        F.length(F.regexp_replace(text, BLANK + "+", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("capitals"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("exclamations"))

    def second(c: Column) -> Column:
        return F.struct(
            F.size(c["words"]).cast("long").alias("n_words"), c["word_chars"], c["n_symbols"],
            (F.size(c["lines"]) - F.size(F.array_distinct(c["lines"]))).cast("long").alias("n_dup_lines"),
            let(shingle_hashes(c["words"], 3), lambda h: _covered(h, 3)).cast("long").alias("n_repeat_words"),
            F.size(c["lines"]).alias("n_lines"), c["capitals"], c["exclamations"])

    def rates(c: Column) -> Column:
        chars = F.greatest(c["word_chars"], F.lit(1))
        words = F.greatest(c["n_words"], F.lit(1))
        return F.struct(
            c["n_words"], c["word_chars"], c["n_symbols"], c["n_dup_lines"], c["n_repeat_words"],
            ((c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])).alias("base_failed"),
            F.struct(
                (c["n_symbols"] / chars).alias("symbols"),
                (c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1))).alias("repeated_lines"),
                (c["n_repeat_words"] / words).alias("repeated_words"),
                (c["capitals"] / chars).alias("capitals"),
                (c["exclamations"] / chars).alias("exclamations"),
                (c["word_chars"] / words).alias("long_words")).alias("rates"))

    return let(let(counts, second), rates)


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X ~ B(n, rate), summed downwards from k by the ratio of neighbouring terms.

    Terms further than 40 standard deviations below k are beyond double precision."""
    odds = (1 - rate) / rate
    reach = F.ceil(40 * F.sqrt(n * rate * (1 - rate)) + 40).cast("long")
    low = F.greatest(F.lit(0), k - reach)
    # ln C(n, k) by sums of logarithms over the shorter side
    side = F.least(k, n - k)
    choose = F.when(side > 0, F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(side, F.lit(1))), F.lit(0.0),
        lambda acc, i: acc + F.log((n - side + i).cast("double") / i))).otherwise(F.lit(0.0))
    first = choose + k * F.lit(math.log(rate)) + (n - k) * F.lit(math.log1p(-rate))
    # sum of terms relative to the first: term(i - 1) = term(i) * i / (n - i + 1) * odds
    relative = F.when(k > low, F.aggregate(
        F.sequence(k, F.least(k, low + 1), F.lit(-1).cast("long")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda acc, i: let(acc["term"] * i / (n - i + 1) * odds,
                           lambda t: F.struct(t.alias("term"), (acc["sum"] + t).alias("sum"))),
        lambda acc: acc["sum"])).otherwise(F.lit(1.0))
    return F.exp(first + F.log(relative))


def _steps(held: DataFrame, cutoffs: dict[str, tuple[float, ...]]) -> list[tuple[str, float]]:
    """(signal, cutoff) in the order of the tests, from documents not labelled good alone."""
    tests = [(name, cut) for name, cuts in cutoffs.items() for cut in cuts]
    share = lambda label: [F.coalesce(F.avg(F.when(
        F.col("label") == label, (F.col(f"rates.{name}") > cut).cast("double"))), F.lit(0.0)) for name, cut in tests]
    shares = held.where("label in ('bad', 'none')").agg(*[
        (bad - none).alias(f"_{j}") for j, (bad, none) in enumerate(zip(share("bad"), share("none")))]).first()
    lead = {name: max(x for x, (other, _) in zip(shares, tests) if other == name) for name in cutoffs}
    return [(name, cut) for name in sorted(cutoffs, key=lambda name: -lead[name])
            for cut in sorted(cutoffs[name], reverse=True)]


def certified_cutoffs(judged: DataFrame, labels: DataFrame, stratum: str = "stratum",
                      max_false_rejection: float = 0.02, confidence_loss: float = 0.05,
                      cutoffs: dict[str, tuple[float, ...]] | None = None) -> DataFrame:
    """One row per stratum of labelled good documents: (stratum, <signal>: lowest certified cutoff
    or null). ``judged`` has doc_id, the stratum and ``s`` as made by ``signals``."""
    cutoffs = cutoffs or CUTOFFS
    known = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.min("quality").alias("_least"), F.max("quality").alias("_most"), F.lit(True).alias("_known")))
    label = F.when(F.col("_known").isNull(), "none").when(F.col("_least") == 1, "good").when(F.col("_most") == 0, "bad")
    held = materialized(
        judged.where(~F.col("s.base_failed") & F.col("doc_id").isNotNull()).join(known, "doc_id", "left")
        .select(F.col(stratum).alias("stratum"), label.alias("label"), "s.rates"), "quality-held")
    steps = _steps(held, cutoffs)
    above = [F.count_if(F.col("_first") <= j).alias(f"_{j}") for j in range(len(steps))]
    first = F.least(F.lit(len(steps)), *[
        F.when(F.col(f"rates.{name}") > cut, j) for j, (name, cut) in enumerate(steps)])
    counted = materialized(
        held.where("label = 'good'").select("stratum", first.alias("_first"))
        .groupBy("stratum").agg(F.count("*").alias("n"), *above), "quality-counts")
    tests = F.inline(F.array(*[
        F.struct(F.lit(name).alias("signal"), F.lit(float(cut)).alias("cutoff"), F.col(f"_{j}").alias("k"))
        for j, (name, cut) in enumerate(steps)]))
    tested = counted.select(F.col("stratum").alias(stratum), "n", tests)
    rate = max_false_rejection
    enough = math.log(confidence_loss) / math.log1p(-rate)
    bound = confidence_loss / max(1, counted.where(F.col("n") >= enough).count())
    # at or above the mean the tail is at least a quarter, far above any bound in use
    passes = F.when((F.col("n") >= enough) & (F.col("k") < rate * F.col("n")),
                    binomial_tail(F.col("k"), F.col("n"), rate) <= bound).otherwise(F.lit(False))
    return tested.groupBy(stratum).agg(*[
        F.min(F.when((F.col("signal") == name) & passes, F.col("cutoff"))).alias(name)
        for name in cutoffs])


def verdict(judged: DataFrame, thresholds: DataFrame, stratum: str = "stratum",
            cutoffs: dict[str, tuple[float, ...]] | None = None) -> DataFrame:
    """``judged`` with ``kept``: false for base failures and for signals above a certified cutoff."""
    names = list(cutoffs or CUTOFFS)
    limits = thresholds.select(F.col(stratum).alias("_stratum"), F.struct(*names).alias("_limits"))
    over = F.lit(False)
    for name in names:
        over = over | F.coalesce(F.col(f"s.rates.{name}") > F.col(f"_limits.{name}"), F.lit(False))
    return (judged.join(limits, F.col(stratum) == F.col("_stratum"), "left")
            .withColumn("kept", ~(F.col("s.base_failed") | over)).drop("_stratum", "_limits"))


def _judged(docs: DataFrame, stratum: Column | None, *carried: Column) -> DataFrame:
    """Signals of every document, written down so that no later pass evaluates them again."""
    stratum = F.col("lang") if stratum is None else stratum
    return materialized(
        docs.select("doc_id", F.coalesce(stratum.cast("string"), F.lit("")).alias("stratum"),
                    signals(F.col("text")).alias("s"), *carried), "quality-signals")


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: Column | None = None,
                  **limits) -> DataFrame:
    """Signals and verdict of every document: (doc_id, stratum, s, kept)."""
    judged = _judged(docs, stratum)
    return verdict(judged, certified_cutoffs(judged, labels, **limits),
                   cutoffs=limits.get("cutoffs"))


def keep_good(docs: DataFrame, labels: DataFrame, stratum: Column | None = None, **limits) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they were.

    Every text is judged once: rows are written down with their signals, and later passes read
    the signals alone until the rows that stay are taken from there."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = _judged(docs, stratum, row)
    thresholds = certified_cutoffs(judged, labels, **limits)
    return verdict(judged, thresholds, cutoffs=limits.get("cutoffs")).where("kept").select("row.*")
