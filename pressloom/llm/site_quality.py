"""Quality by hierarchical empirical Bayes: a document's own evidence, its path's and its host's.

A naive Bayes classifier over binned counts of a text, learnt from labelled documents, gives each
document its evidence. Hosts and their paths then gather the evidence of their documents: a host's
rate of good documents is shrunk towards the global rate, a path's towards its host's, each as far as
sparse groups must be, with the strength estimated from how much hosts, and paths within hosts,
really differ. A document's quality combines its evidence with what the others on its path show.

Null texts are empty, null hosts and paths are groups of their own. Without labels all evidence is
even. A document alone on its path gets its host's rate, alone on its host the global one. Several
labels of a document count one each. Repeated rows are judged and counted each, and nothing is ranked, so
there are no ties. A text of any length is counted whole. An empty table gives no rows. Only id, text and the
columns named for host and path are read of a table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.quality_rules import measured
from pressloom.llm.shared import stored

KEEP = 0.5
BINS, SMOOTHING = 20, 1.0
#: Naive Bayes counts related evidence twice; the factor that fits the labels best tempers it.
TEMPERS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0)
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6
#: Statistics of up to so many paths are broadcast, more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def bins() -> Column:
    """Per feature the bin of its value, 0 to ``BINS``; without words, bin -1 of all but the first."""
    n = F.when(F.col("n_words") > 0, F.col("n_words"))
    chars = F.when(F.col("word_chars") > 0, F.col("word_chars"))
    letters = F.when(F.col("n_letters") > 0, F.col("n_letters"))
    lines = F.when(F.col("n_lines") > 0, F.col("n_lines"))
    scaled = [
        F.log2(F.col("n_words") + 1),
        F.col("word_chars") / n,
        F.log2(F.col("n_symbols") / n * 500 + 1) * 2,
        F.col("n_dup_lines") / lines * BINS,
        F.log2(F.col("n_repeat_words") / n * 500 + 1) * 2,
        F.col("n_capitals") / letters * BINS,
        F.log2(F.col("n_stops") / n * 500 + 1) * 2,
        F.col("n_letters") / chars * BINS,
        F.log2(F.col("n_shouts") / n * 500 + 1) * 2,
    ]
    return F.array(*(F.coalesce(F.least(F.floor(v), F.lit(BINS)), F.lit(-1)).cast("int") for v in scaled))


@dataclass
class Classifier:
    prior: float  # log-odds of good
    odds: list[dict[int, float]]  # per feature and bin
    temper: float = 1.0

    def evidence(self) -> Column:
        """Log-odds that a document is good, from its ``bins``; a bin never seen says nothing."""
        own = F.lit(0.0)
        for i, odds in enumerate(self.odds):
            if odds:
                known = F.create_map(*(F.lit(x) for pair in sorted(odds.items()) for x in pair))
                own = own + F.coalesce(known[F.col("bins")[i]], F.lit(0.0))
        return F.lit(self.prior) + self.temper * own


def fit(binned: DataFrame, labels: DataFrame) -> Classifier:
    """From doc_id and bins, and labels (doc_id, quality 0 or 1), by counts over all labelled documents."""
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("good"))
    rows = stored(binned.select("doc_id", "bins").join(known, "doc_id").select("bins", "good"))
    sizes = {r.good: r["count"] for r in rows.groupBy("good").count().collect()}
    good, bad = sizes.get(1, 0), sizes.get(0, 0)
    prior = math.log((good + SMOOTHING) / (bad + SMOOTHING))
    odds: list[dict[int, float]] = [{} for _ in range(9)]
    for r in (
        rows.select("good", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("feature", "bin")
        .agg(F.sum("good").alias("good"), F.count("*").alias("n"))
        .collect()
    ):
        on_good = (r.good + SMOOTHING) / (good + SMOOTHING * (BINS + 2))
        on_bad = (r.n - r.good + SMOOTHING) / (bad + SMOOTHING * (BINS + 2))
        odds[r.feature][r.bin] = math.log(on_good / on_bad)
    if not good or not bad:
        return Classifier(prior, odds)
    fits = []
    for temper in TEMPERS:
        p = _probability(Classifier(prior, odds, temper).evidence())
        fits.append(F.avg(F.log(F.when(F.col("good") == 1, p).otherwise(1 - p) + 1e-12)).alias(f"t{temper}"))
    likelihood = rows.agg(*fits).first()
    return Classifier(prior, odds, max(zip(likelihood, TEMPERS, strict=True))[1])


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _strength(spread: float, groups: float, rows: float, squares: float, mean: float) -> float:
    """How many documents a prior is worth: from the spread of group means, less what chance gives."""
    noise = mean * (1 - mean)
    between = (spread - groups * noise) / max(rows - squares, 1e-9)
    if between <= 0 or noise <= 0:
        return MOST_STRENGTH
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, noise / between - 1))


def combined(scored: DataFrame) -> DataFrame:
    """host_quality, path_quality and quality from evidence, host and path."""
    p = _probability(F.col("evidence"))
    paths = stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("good")))
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good")))
    n, mean = F.col("host_n"), F.col("host_good") / F.col("host_n")
    total, good = hosts.agg(F.sum("host_n"), F.sum("host_good")).first()
    rate = min(1 - 1e-6, max(1e-6, good / total)) if total else 0.5
    spread, count, squares = hosts.agg(F.sum(n * (mean - rate) ** 2), F.count("*"), F.sum(n * n / F.lit(float(total or 1)))).first()
    host_strength = _strength(spread or 0.0, (count or 1) - 1, float(total or 0), squares or 0.0, rate)
    # Hosts are joined null-safely: rows without a host are a group too.
    both = paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    both = stored(both)
    own, of_host = F.col("good") / F.col("n"), (F.col("host_good") + host_strength * rate) / (n + host_strength)
    spread, count, squares = both.agg(F.sum(F.col("n") * (own - of_host) ** 2), F.count("*"), F.sum(F.col("n") ** 2 / n)).first()
    path_strength = _strength(spread or 0.0, (count or 1) - (hosts.count() or 1), float(total or 0), squares or 0.0, rate)

    known = both.withColumnsRenamed({"host": "h", "path": "q"})
    known = F.broadcast(known) if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else known
    rows = scored.join(known, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")), "left")
    # What the other documents show: a document's own evidence counts once.
    rows = rows.withColumn("host_quality", (F.col("host_good") - p + host_strength * rate) / (n - 1 + host_strength))
    rows = rows.withColumn("path_quality", (F.col("good") - p + path_strength * F.col("host_quality")) / (F.col("n") - 1 + path_strength))
    site = F.least(F.greatest("path_quality", F.lit(1e-6)), F.lit(1 - 1e-6))
    odds = F.col("evidence") + F.log(site / (1 - site)) - math.log(rate / (1 - rate))
    return rows.withColumn("quality", _probability(odds)).drop("h", "q", "n", "good", "host_n", "host_good")


def judged(docs: DataFrame, labels: DataFrame, host: Column, path: Column, keep: float = KEEP) -> DataFrame:
    """doc_id, evidence, host_quality, path_quality, quality and kept for every row of ``docs``."""
    sites = docs.select("doc_id", "text", host.cast("string").alias("host"), path.cast("string").alias("path"))
    binned = measured(sites, "host", "path").withColumn("bins", bins())
    binned = stored(binned.select("doc_id", "host", "path", "bins"))
    model = fit(binned, labels)
    rows = combined(binned.withColumn("evidence", model.evidence()).drop("bins"))
    rows = rows.withColumn("kept", F.col("quality") >= keep)
    return rows.select("doc_id", "evidence", "host_quality", "path_quality", "quality", "kept")
