"""Quality classifier: document evidence with hierarchical empirical Bayes over host and path.

A logistic model gives each document's evidence of good quality. Sums of that evidence per (host, path)
are grouped in Spark. Each host's rate is shrunk toward the global rate by a weight that the spread
between hosts gives (method of moments), each path's rate toward its host's. A document's verdict adds
its own evidence to its site's rate, from which it is left out itself.

Defined cases: null or empty texts have zero counts and are judged like any other; a null host or path
is a site of its own; equal rows count each and are judged alike, evidence at the threshold (a tie) is kept; a text of any length is counted whole; without labels of both kinds every document gets the neutral 0.5 and is kept;
an empty table gives an empty result. Columns named like a result are replaced, all others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetday.llm.quality_rules import labelled
from fleetday.llm.statistics import ratios, text_counts
from fleetday.sources.tables import stage


@dataclass(frozen=True)
class Logistic:
    names: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weight: tuple[float, ...]
    bias: float
    prior: float  # share of good labels

    def log_odds(self, columns: dict[str, Column]) -> Column:
        out = F.lit(self.bias)
        for n, m, s, w in zip(self.names, self.mean, self.scale, self.weight):
            x = (columns[n] - F.lit(m)) / F.lit(s)
            out = out + F.lit(w) * F.greatest(F.lit(-6.0), F.least(F.lit(6.0), x))
        return F.greatest(F.lit(-20.0), F.least(F.lit(20.0), out))


def learn(x: np.ndarray, good: np.ndarray, names: list[str], ridge: float = 1.0) -> Logistic:
    """Ridge logistic regression by Newton steps on standardised, clipped features."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.column_stack([np.clip((x - mean) / scale, -6, 6), np.ones(len(x))])
    w, keep = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(keep), z.T @ (good - p) - keep * w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(tuple(names), tuple(map(float, mean)), tuple(map(float, scale)), tuple(map(float, w[:-1])), float(w[-1]), float(good.mean()))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
        most_labels: int = 20_000) -> Logistic | None:
    """The document model from at most `most_labels` labelled rows; None without rows of both kinds."""
    sample = labelled(docs, labels, label, doc_id, text, most_labels).withColumn("_c", text_counts(F.col("_text")))
    names = list(ratios("_c"))
    rows = sample.select("_id", "_label", *[c.alias(n) for n, c in ratios("_c").items()]).toPandas()
    if rows["_label"].nunique() < 2:
        return None
    rows = rows.sort_values(["_id", "_label", *names])
    return learn(rows[names].to_numpy(float), rows["_label"].to_numpy(float), names)


def evidence(docs: DataFrame, model: Logistic | None, text: str = "text") -> DataFrame:
    """`docs` with `_odds`, the log-odds of good quality from the text alone, and `_p`."""
    if model is None:
        return docs.withColumns({"_odds": F.lit(0.0), "_p": F.lit(0.5)})
    scored = docs.withColumn("_c", text_counts(F.col(text)))
    scored = scored.withColumn("_odds", model.log_odds(ratios("_c"))).drop("_c")
    return scored.withColumn("_p", 1 / (1 + F.exp(-F.col("_odds"))))


def sites(scored: DataFrame, host: Column, path: Column) -> DataFrame:
    """One row per (host, path) with its rows and evidence, and those of its host.

    Only sums are shuffled: a site with a third of all documents is one row per task. Written once,
    as the prior and the verdicts both read it.
    """
    by_path = stage(
        scored.groupBy(host.alias("_host"), path.alias("_path")).agg(F.count(F.lit(1)).alias("_n"), F.sum("_p").alias("_s")),
        "sites",
    )
    by_host = by_path.groupBy("_host").agg(F.sum("_n").alias("_hn"), F.sum("_s").alias("_hs")).withColumnRenamed("_host", "_h")
    return stage(by_path.join(by_host, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h"), "sites")


@dataclass(frozen=True)
class Priors:
    rate: float  # global rate of good evidence
    host: float  # weight of the global rate in a host's rate, in documents
    path: float  # weight of the host's rate in a path's rate, in documents


def _weight(rate: float, squares: float, freedom: int, effective: float) -> float:
    """m(1-m)/v - 1 from sums of squares between groups; v is what counting noise doesn't explain."""
    noise = max(rate * (1 - rate), 1e-9)
    spread = (squares - freedom * noise) / effective if effective > 0 else 0.0
    return min(1e4, max(1.0, noise / max(spread, 1e-9) - 1))


def priors(table: DataFrame) -> Priors:
    """The prior weights by the method of moments; one row of sums reaches the driver."""
    host = table.groupBy("_host").agg(
        F.first("_hn").alias("n"), F.first("_hs").alias("s"), F.count(F.lit(1)).alias("paths"),
        F.sum(F.col("_s") * F.col("_s") / F.col("_n")).alias("q"), F.sum(F.col("_n").cast("double") * F.col("_n")).alias("n2"),
    )
    r = host.agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("hosts"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"), F.sum(F.col("n").cast("double") * F.col("n")).alias("n2"),
        F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("path_q"), F.sum(F.col("paths") - 1).alias("path_d"),
        F.sum(F.col("n") - F.col("n2") / F.col("n")).alias("path_e"),
    ).first()
    if not r.n:
        return Priors(0.5, 1.0, 1.0)
    rate = r.s / r.n
    return Priors(
        rate, _weight(rate, r.q - r.s * r.s / r.n, r.hosts - 1, r.n - r.n2 / r.n), _weight(rate, r.path_q, r.path_d, r.path_e)
    )


def judge(scored: DataFrame, table: DataFrame, prior: Priors, host: Column, path: Column, threshold: float = 0.5) -> DataFrame:
    """`scored` with `host_rate`, `site_rate`, `p_good` and `kept`, each without the document's own part."""
    keyed = scored.drop("host_rate", "site_rate", "p_good", "kept").withColumns({"_host0": host, "_path0": path})
    joined = keyed.join(
        table, F.col("_host0").eqNullSafe(F.col("_host")) & F.col("_path0").eqNullSafe(F.col("_path")), "left"
    )
    host_rate = (F.lit(prior.host * prior.rate) + F.col("_hs") - F.col("_p")) / (F.lit(prior.host) + F.col("_hn") - 1)
    site_rate = (F.lit(prior.path) * F.col("host_rate") + F.col("_s") - F.col("_p")) / (F.lit(prior.path) + F.col("_n") - 1)
    odds = lambda p: F.log(p / (1 - p))
    inside = lambda p: F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), p))
    base = min(1 - 1e-4, max(1e-4, prior.rate))
    total = F.col("_odds") + odds(inside(F.col("site_rate"))) - F.lit(float(np.log(base / (1 - base))))
    return (
        joined.withColumn("host_rate", host_rate).withColumn("site_rate", site_rate)
        .withColumn("p_good", 1 / (1 + F.exp(-total))).withColumn("kept", F.col("p_good") >= threshold)
        .drop("_host0", "_path0", "_host", "_path", "_n", "_s", "_hn", "_hs")
    )
