"""Quality rules under weak supervision: votes, accuracies by EM, posterior quality.

Everything per document is DataFrame expressions. The corpus enters the estimation as the
count of each vote pattern, of which there are at most 3 ** rules.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.common import word_array, written

SYMBOLS = "#*$%&|<>"
#: Words of a repetition window.
WINDOW = 3
#: Words that distinct ones are held against at most.
VOCABULARY = 2_000

#: Frequent function words of the corpus's languages.
STOP_WORDS = ("the of and to in a is that for it was on are as with his they at be this from "
              "der die und das von zu den mit sich des auf ist im dem nicht ein eine als auch "
              "la le les et des un une du en que est pour dans qui par "
              "el los las y del se con no por su para al lo").split()


class Rule(NamedTuple):
    """A rule abstains where both conditions fail or its inputs are null."""

    name: str
    reject: Column
    accept: Column


def text_stats(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Exact per-document counts the rules are built on.

    n_words, word_chars, n_symbols, n_lines (lines with a word), n_dup_lines (those equal to
    an earlier line), n_repeat_words (words in windows of three that occur at least twice,
    the first occurrence included), n_stop, n_distinct, n_ended (words that end a sentence),
    n_digits. Null and blank texts count zero everywhere.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.select(*carry, body.alias("__text")).withColumn("__words", word_array(F.col("__text")))
    words = F.col("__words")
    size = F.size(words)
    window = F.transform(
        F.sequence(F.lit(0), size - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    out = out.withColumn("__windows", F.when(size >= WINDOW, window)
                         .otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn("__lines", F.filter(F.split("__text", "\n", -1),
                                             lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n_symbols = F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))
    lowered = F.transform(words, lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")))
    out = out.withColumns({
        "n_words": size.cast("long"),
        "word_chars": F.length(F.translate("__text", " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": n_symbols.cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_distinct": F.size(F.array_distinct(words)).cast("long"),
        "n_stop": F.size(F.filter(lowered, lambda w: w.isin(*STOP_WORDS))).cast("long"),
        "n_ended": F.regexp_count("__text", F.lit(r"[.!?](?=[\x20\x09-\x0D]|$)")).cast("long"),
        "n_digits": F.regexp_count("__text", F.lit("[0-9]")).cast("long"),
        # windows in order of hash, with their place; only where any repeats
        "__ordered": F.when(
            F.size(F.array_distinct("__windows")) < F.size("__windows"),
            F.sort_array(F.transform("__windows", lambda g, i: F.struct(
                g.alias("g"), i.alias("i")))))})
    ordered = F.col("__ordered")
    repeated = F.filter(F.transform(ordered, lambda x, k: F.when(
        (F.get(ordered, k - 1)["g"] == x["g"]) | (F.get(ordered, k + 1)["g"] == x["g"]), x["i"])),
        lambda i: i.isNotNull())
    out = out.withColumn("__repeated", F.sort_array(repeated))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    covered = F.aggregate("__repeated", start, lambda acc, i: F.struct(
        (i + WINDOW).alias("end"),
        (acc["total"] + i + WINDOW - F.greatest(i, acc["end"])).alias("total")))
    out = out.withColumn("n_repeat_words", F.coalesce(covered["total"], F.lit(0)).cast("long"))
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def base_failed() -> Column:
    """The plain filter: under 50 words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> list[Rule]:
    words = F.col("n_words")

    def share(name: str, of: Column = words) -> Column:
        return F.when(of > 0, F.col(name) / of)

    def high(name: str, accept: float, reject: float, of: Column = words) -> Rule:
        """Little of it speaks for a document, much of it against."""
        return Rule(name, share(name, of) > reject, share(name, of) <= accept)

    def low(name: str, reject: float, accept: float, of: Column = words) -> Rule:
        return Rule(name, share(name, of) < reject, share(name, of) >= accept)

    mean = share("word_chars")
    # new words get rarer as a text goes on, so words beyond the vocabulary of a page do not count
    variety = share("n_distinct", F.least(words, F.lit(VOCABULARY)))
    return [
        Rule("length", words < 20, words >= 50),
        Rule("word_length", (mean < 2.5) | (mean > 12), mean.between(3, 9)),
        high("n_symbols", 0.02, 0.1),
        high("n_dup_lines", 0.1, 0.3, F.col("n_lines")),
        high("n_repeat_words", 0.1, 0.3),
        low("n_stop", 0.06, 0.12),
        low("n_ended", 0.005, 0.02),
        Rule("n_distinct", (words >= 50) & (variety < 0.25), variety >= 0.4),
        high("n_digits", 0.1, 0.5),
    ]


ACCEPT, REJECT, ABSTAIN = "a", "r", "-"


def votes(stats: DataFrame, of: list[Rule]) -> DataFrame:
    """Adds ``votes``: one letter per rule."""
    letter = [F.when(r.reject, REJECT).when(r.accept, ACCEPT).otherwise(ABSTAIN) for r in of]
    return stats.withColumn("votes", F.concat(*letter))


class Model(NamedTuple):
    """Prior of quality, and per rule the chance to accept a good and to reject a bad one."""

    prior: float
    accepts_good: list[float]
    rejects_bad: list[float]


def fit(patterns: dict[str, int], n_rules: int, rounds: int = 100) -> Model:
    """Accuracies and prior by expectation-maximisation over counted vote patterns.

    A rule's abstention says nothing about quality. It starts from the plain reading, that
    a document with any rejecting vote is probably bad, and never lets a rule speak against
    its own vote. Without patterns the start is returned.
    """
    model = Model(0.5, [0.9] * n_rules, [0.6] * n_rules)
    total = sum(patterns.values())
    belief = {p: 0.1 if REJECT in p else 0.9 for p in patterns}
    for _ in range(rounds if total else 0):
        prior = sum(n * belief[p] for p, n in patterns.items()) / total
        good, bad = [], []
        for j in range(n_rules):
            ag = rg = ab = rb = 0.0
            for p, n in patterns.items():
                if p[j] == ACCEPT:
                    ag += n * belief[p]
                    ab += n * (1 - belief[p])
                elif p[j] == REJECT:
                    rg += n * belief[p]
                    rb += n * (1 - belief[p])
            accept = (ag + 9) / (ag + rg + 10)
            reject = (rb + 1) / (ab + rb + 4)
            good.append(min(accept, 0.9999))
            bad.append(min(max(reject, 1 - accept), 0.9999))
        new = Model(min(max(prior, 0.01), 0.99), good, bad)
        moved = max(abs(a - b) for a, b in zip(
            [new.prior, *new.accepts_good, *new.rejects_bad],
            [model.prior, *model.accepts_good, *model.rejects_bad], strict=True))
        model = new
        belief = {p: posterior(model, p) for p in patterns}
        if moved < 1e-9:
            break
    return model


def _weights(model: Model) -> list[tuple[float, float]]:
    """Log odds that an accepting and a rejecting vote add, per rule."""
    return [(math.log(g / (1 - b)), math.log((1 - g) / b))
            for g, b in zip(model.accepts_good, model.rejects_bad, strict=True)]


def posterior(model: Model, pattern: str) -> float:
    odds = math.log(model.prior / (1 - model.prior))
    for vote, (accept, reject) in zip(pattern, _weights(model), strict=True):
        odds += accept if vote == ACCEPT else reject if vote == REJECT else 0.0
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def posterior_column(model: Model) -> Column:
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for j, (accept, reject) in enumerate(_weights(model)):
        vote = F.substring("votes", j + 1, 1)
        odds = odds + F.when(vote == ACCEPT, accept).when(vote == REJECT, reject).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def weak_quality(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, the counts, votes, p_quality, base_failed and kept of every row.

    A null or blank text has zero counts, fails the base filter and is not kept; repeated
    rows are judged alike. An empty table gives an empty result. Columns of ``docs`` other
    than ``carry`` and ``text`` are not read, so their names cannot clash.
    """
    of = rules()
    judged = written(votes(text_stats(docs, carry), of), "votes")
    patterns = {r["votes"]: r["n"] for r in
                judged.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = fit(patterns, len(of))
    return (judged.withColumn("p_quality", posterior_column(model))
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_quality") >= 0.5)))
