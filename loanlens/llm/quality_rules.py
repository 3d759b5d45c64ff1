"""Quality rules as weak supervision: votes, estimated accuracies, posterior.

Every rule votes good (1), bad (-1) or abstains (0) on a text.  Rules with few
distinct votes give few distinct vote patterns, so one aggregation over all
documents yields all that expectation-maximisation needs: at most 3 ** rules
counts.  The estimated rates turn each document's votes into the posterior
probability of being good, as one column expression.

Only column functions run on the rows.  The measures are written once to the
shared folder, since both the counts and the verdicts read them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import BLANKS, bind, blank_split
from loanlens.session import stored

# Frequent function words of the corpus languages.
STOP_WORDS = (
    "the and of to in is that for with was "
    "der die und das den von zu mit ist nicht "
    "le la les de des et un une dans que "
    "el los las que en por con del una para"
).split()

MIN_WORDS = 50


@dataclass(frozen=True)
class Rule:
    """SQL conditions on the measures; neither holding is an abstention."""

    name: str
    good: str
    bad: str


# All rules are ratios of whole-text counts; `m` is the struct of measures.
RULES = (
    Rule("length", "m.n_words >= 80", "m.n_words < 50"),
    Rule("word_length", "m.word_chars between 3 * m.n_words and 10 * m.n_words",
         "m.word_chars < 2 * m.n_words or m.word_chars > 14 * m.n_words"),
    Rule("symbols", "100 * m.n_symbols <= m.n_words", "10 * m.n_symbols > m.n_words"),
    Rule("repeated_lines", "m.n_lines > 1 and 10 * m.n_dup_lines <= m.n_lines",
         "10 * m.n_dup_lines > 3 * m.n_lines"),
    Rule("repeated_words", "5 * m.n_repeat_words <= m.n_words", "2 * m.n_repeat_words > m.n_words"),
    Rule("capitals", "5 * m.n_upper <= m.word_chars", "5 * m.n_upper > 2 * m.word_chars"),
    Rule("digits", "20 * m.n_digits <= m.word_chars", "5 * m.n_digits > m.word_chars"),
    Rule("stop_words", "m.n_stop_words >= 3", "m.n_stop_words = 0"),
)

MEASURES = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_upper n_digits n_stop_words"
).split()


def _count(text: Column, characters: str) -> Column:
    """Number of the text's code points in a regular expression's character class."""
    return F.regexp_count(text, F.lit(f"[{characters}]"))


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more.

    Windows are compared by a 64-bit hash of their words.  Sorting the hashes
    with their places puts equal windows side by side; the places found then
    count 3 words each, less what the next window shares.
    """

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    def repeats(sorted_windows: Column) -> Column:
        def same(x: Column, i: Column) -> Column:
            h = x["h"]
            before, after = F.get(sorted_windows, i - 1)["h"], F.get(sorted_windows, i + 1)["h"]
            return F.coalesce(h == before, F.lit(False)) | F.coalesce(h == after, F.lit(False))

        return F.sort_array(F.transform(F.filter(sorted_windows, same), lambda x: x["p"]))

    def count(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        found = bind(bind(placed, repeats), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(found)

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(bind(hashes, count))


def measures(text: Column) -> Column:
    """Counts over the whole text as one struct of longs; null counts as empty."""

    def lines(all_lines: Column) -> Column:
        worded = F.filter(all_lines, lambda x: x.rlike(f"[^{BLANKS}]"))
        return bind(
            worded,
            lambda w: F.struct(F.size(w).alias("n"), (F.size(w) - F.size(F.array_distinct(w))).alias("dup")),
        )

    def all_of(t: Column, words: Column, ln: Column) -> Column:
        values = {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": _count(t, "#*$%&|<>"),
            "n_lines": ln["n"],
            "n_dup_lines": ln["dup"],
            "n_repeat_words": _repeated(words),
            "n_upper": _count(t, "A-Z"),
            "n_digits": _count(t, "0-9"),
            "n_stop_words": F.size(F.array_intersect(F.array(*map(F.lit, STOP_WORDS)), words)),
        }
        return F.struct(*[values[k].cast("long").alias(k) for k in MEASURES])

    return bind(
        F.coalesce(text, F.lit("")),
        lambda t: bind(
            blank_split(t), lambda words: bind(lines(F.split(t, "\n")), lambda ln: all_of(t, words, ln))
        ),
    )


def vote(rule: Rule) -> Column:
    return F.expr(f"case when {rule.bad} then -1 when {rule.good} then 1 else 0 end")


@dataclass(frozen=True)
class Model:
    """Share of good documents, and per rule the rate of good votes in either class."""

    prior: float
    good: tuple[float, ...]
    bad: tuple[float, ...]

    def log_odds(self, votes: Sequence[int]) -> float:
        x = math.log(self.prior / (1 - self.prior))
        for v, g, b in zip(votes, self.good, self.bad):
            x += (math.log(g / b) if v > 0 else math.log((1 - g) / (1 - b))) if v else 0.0
        return x


LEAST = 0.001


def fit(patterns: Sequence[tuple[Sequence[int], int]], rounds: int = 100) -> Model:
    """Expectation-maximisation over (votes, number of documents).

    Two classes with their own vote rates per rule; an abstention says nothing.
    The first guess is each pattern's share of good votes, which fixes which
    class is the good one; a rule never counts a good vote as a bad sign.
    Without documents or votes the model is undecided.
    """
    k = len(patterns[0][0]) if patterns else len(RULES)
    total = sum(n for _, n in patterns)
    if not total:
        return Model(0.5, (0.5,) * k, (0.5,) * k)
    # two bad votes already make the bad class the likelier first guess
    belief = [
        1 / (1 + math.exp(-2.0 * (1.5 - sum(v < 0 for v in votes) * 1.5 + 0.25 * sum(v > 0 for v in votes))))
        for votes, _ in patterns
    ]
    model = Model(0.5, (0.5,) * k, (0.5,) * k)
    for _ in range(rounds):
        share = sum(n * q for (_, n), q in zip(patterns, belief)) / total
        rates = []
        for j in range(k):
            seen = [(votes[j], n, q) for (votes, n), q in zip(patterns, belief) if votes[j]]
            g = (1 + sum(n * q for v, n, q in seen if v > 0)) / (2 + sum(n * q for _, n, q in seen))
            b = (1 + sum(n * (1 - q) for v, n, q in seen if v > 0)) / (2 + sum(n * (1 - q) for _, n, q in seen))
            g = min(max(g, LEAST), 1 - LEAST)
            rates.append((g, min(max(b, LEAST), g)))
        model = Model(
            min(max(share, LEAST), 1 - LEAST), tuple(g for g, _ in rates), tuple(b for _, b in rates)
        )
        belief = [1 / (1 + math.exp(-max(-500.0, min(500.0, model.log_odds(votes))))) for votes, _ in patterns]
    return model


def _posterior(model: Model) -> Column:
    x = F.lit(math.log(model.prior / (1 - model.prior)))
    for j, (g, b) in enumerate(zip(model.good, model.bad)):
        v = F.get("_votes", F.lit(j))
        x = x + F.when(v > 0, math.log(g / b)).when(v < 0, math.log((1 - g) / (1 - b))).otherwise(0.0)
    return 1 / (1 + F.exp(-x))


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    min_words: int = MIN_WORDS,
    least: float = 0.5,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Documents with their measures, votes, posterior quality and verdict.

    Returns the columns ``keep`` (default all) as the struct ``row``, the
    struct ``m`` of measures, ``votes``, ``base_failed``, ``quality`` and
    ``kept``; the struct keeps columns of any name apart from the results.
    ``base_failed`` holds with fewer than ``min_words`` words, or when more than
    half of them are repeated; ``kept`` needs that it does not hold and a
    posterior of at least ``least``.

    A null text has no words, so it fails like an empty one.  Null keys pass
    through; repeated rows are judged alike, each of them.  An empty table gives
    an empty result.
    """
    names = docs.columns if keep is None else list(keep)
    measured = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), measures(F.col(text)).alias("m"))
    voted = stored(measured.select("row", "m", F.array(*map(vote, rules)).alias("_votes")), "measures")
    # at most 3 ** len(rules) patterns come back
    counts = voted.groupBy("_votes").agg(F.count("*").alias("n")).collect()
    model = fit(sorted((tuple(r["_votes"]), r["n"]) for r in counts))
    base_failed = F.expr(f"m.n_words < {min_words} or 100 * m.n_repeat_words > 50 * m.n_words")
    quality = _posterior(model)
    return voted.select(
        "row",
        "m",
        F.col("_votes").alias("votes"),
        base_failed.alias("base_failed"),
        quality.alias("quality"),
        (~base_failed & (quality >= least)).alias("kept"),
    )


def keep_good(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that are kept, with their columns as they came."""
    return quality_rules(docs, text, **options).where("kept").select("row.*")
