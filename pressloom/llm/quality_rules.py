"""Quality by weak supervision: rules vote or abstain, and their accuracies are learnt from agreement.

Each rule votes good (1) or bad (-1) on a document, or abstains (0). Documents are counted by their
votes, at most 3^8 combinations, and expectation-maximisation on these counts estimates how common
good documents are and how often each rule is right on good and on bad ones. A document's posterior
probability of being good follows from its votes; it is kept from ``KEEP`` on. Everything is DataFrame
functions; texts are read once.

Null and empty texts have no words and fail the base rules. Ties do not arise: equal votes get equal
probabilities. Repeated rows are judged and counted each. A text of any length is counted whole. An empty
table gives no rows. Only id and text are read of a table, whatever other columns it has.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.shared import stored

KEEP = 0.5
LEAST_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
ROUNDS, CLOSE = 50, 1e-3
#: What is believed of rules at first: they rarely fault good documents and miss most faults of bad
#: ones, each being about one fault. Pseudo-votes keep accuracies off 0 and 1.
ON_GOOD, ON_BAD, GOOD, PRIOR_VOTES, EDGE = 0.99, 0.25, 0.8, 1.0, 0.001

_BLANK = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas refer to it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text."""
    bare = F.btrim(text, F.lit(_BLANK))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def _repeated(found: Column) -> Column:
    """How many words lie in windows of ``WINDOW`` words that occur twice or more."""

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def total(s: Column) -> Column:
            twice = F.filter(s, lambda e, i: (F.get(s, i - 1)["h"] == e["h"]) | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)))
            start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
            return F.aggregate(
                F.sort_array(F.transform(twice, lambda e: e["i"])),
                start,
                lambda done, i: F.struct((i + WINDOW).alias("end"), (done["n"] + i + WINDOW - F.greatest(i, done["end"])).alias("n")),
            )["n"]

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(placed, total))

    def windows(own: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(own) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(own, i, WINDOW)))

    hashes = let(F.transform(found, lambda w: F.xxhash64(w)), windows)
    return F.when(F.size(found) >= WINDOW, let(hashes, covered)).otherwise(F.lit(0).cast("long"))


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def measured(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, carried columns and the counts that base rules and votes are made of."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_BLANK)) != "")

    def counts(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_words"),
            F.length(F.array_join(found, "")).cast("long").alias("word_chars"),
            _repeated(found).alias("n_repeat_words"),
        )

    def line_counts(own: Column) -> Column:
        return F.struct(F.size(own).cast("long").alias("n_lines"), (F.size(own) - F.size(F.array_distinct(own))).cast("long").alias("n_dup_lines"))

    rows = docs.select(
        "doc_id",
        *carried,
        let(words(text), counts).alias("w"),
        let(lines, line_counts).alias("l"),
        _without(text, r"[^#*$%&|<>]+").alias("n_symbols"),
        _without(text, r"[^\p{L}]+").alias("n_letters"),
        _without(text, r"[^\p{Lu}]+").alias("n_capitals"),
        _without(text, r"[^.?!。]+").alias("n_stops"),
        _without(text, r"[^!]+").alias("n_shouts"),
    )
    return rows.select("doc_id", *carried, "w.*", "l.*", "n_symbols", "n_letters", "n_capitals", "n_stops", "n_shouts")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules: each a vote from the counts of a document. Without words all abstain."""
    n = F.when(F.col("n_words") > 0, F.col("n_words"))
    chars = F.when(F.col("word_chars") > 0, F.col("word_chars"))
    letters = F.when(F.col("n_letters") > 0, F.col("n_letters"))
    lines = F.when(F.col("n_lines") > 1, F.col("n_lines"))
    length, symbols, repeats = F.col("word_chars") / n, F.col("n_symbols") / n, F.col("n_repeat_words") / n
    duplicates, capitals, stops = F.col("n_dup_lines") / lines, F.col("n_capitals") / letters, F.col("n_stops") / n
    return {
        "long_enough": _vote(n >= 50, n < 30),
        "word_length": _vote(length.between(3, 10), (length < 2) | (length > 14)),
        "few_symbols": _vote(symbols <= 0.02, symbols > 0.1),
        "new_lines": _vote(duplicates <= 0.1, (duplicates > 0.3) & (F.col("n_dup_lines") > 2)),
        "no_repeats": _vote(repeats <= 0.05, repeats > 0.2),
        "lower_case": _vote(capitals <= 0.2, capitals > 0.4),
        "sentences": _vote(stops.between(0.01, 0.4) & (F.col("n_shouts") <= 0.1 * n), ((stops < 0.005) & (n >= 50)) | (F.col("n_shouts") > 0.3 * n)),
        "letters": _vote(F.col("n_letters") >= 0.85 * chars, F.col("n_letters") < 0.7 * chars),
    }


@dataclass
class Model:
    good: float  # share of good documents
    right: list[tuple[float, float]]  # per rule: how often its votes are right on good, on bad documents

    def posterior(self, rules: list[str]) -> Column:
        odds = F.lit(0.0) + F.log(F.lit(self.good / (1 - self.good)))
        for rule, (on_good, on_bad) in zip(rules, self.right, strict=True):
            for_, against = F.log(F.lit(on_good / (1 - on_bad))), F.log(F.lit((1 - on_good) / on_bad))
            odds = odds + F.when(F.col(rule) == 1, for_).when(F.col(rule) == -1, against).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit(voted: DataFrame, rules: list[str], rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over the counts of vote combinations, one small query a round."""
    model = Model(GOOD, [(ON_GOOD, ON_BAD)] * len(rules))
    counts = stored(voted.groupBy(*rules).agg(F.count("*").alias("n")).coalesce(1))
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return model
    for _ in range(rounds):
        p, n = model.posterior(rules), F.col("n")
        sums = [F.sum(n * p)]
        for rule in rules:
            vote = F.col(rule)
            for weight, sign in ((n * p, 1), (n * (1 - p), -1)):
                sums.append(F.sum(F.when(vote == sign, weight).otherwise(0.0)))
                sums.append(F.sum(F.when(vote != 0, weight).otherwise(0.0)))
        got = counts.agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).first()

        def share(i: int, believed: float, got=got) -> float:
            return min(1 - EDGE, max(EDGE, (got[i] + PRIOR_VOTES * believed) / (got[i + 1] + PRIOR_VOTES)))

        right = []
        for r in range(len(rules)):
            on_good = share(4 * r + 1, ON_GOOD)
            # A vote for a document never counts against it, so "good" keeps its meaning.
            right.append((on_good, max(share(4 * r + 3, ON_BAD), 1 - on_good)))
        new = Model(min(1 - EDGE, max(EDGE, got[0] / total)), right)
        moved = max(abs(new.good - model.good), *(abs(x - y) for a, b in zip(new.right, model.right, strict=True) for x, y in zip(a, b, strict=True)))
        model = new
        if moved < CLOSE:
            break
    return model


def scored(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """Counts, base verdict, votes, quality (the posterior) and kept for every row of ``docs``."""
    rules = votes()
    voted = stored(measured(docs).select("*", *(vote.alias(rule) for rule, vote in rules.items())))
    model = fit(voted, list(rules))
    n = F.col("n_words")
    failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * n)
    judged = voted.withColumn("base_failed", failed).withColumn("quality", model.posterior(list(rules)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep))
