"""Quality rules: a decision list learned by sequential covering.

Labelled statistics are covered rule by rule. A rule is a conjunction of thresholds that grows by the
gain in information about low quality and is then pruned on held-back rows; the rows that it covers are
removed and the next rule is learned. The list becomes one ordered Spark CASE expression.

Defined cases: a null or empty text has zero counts and fails the base rule; without labels, or without
rows of both kinds, the list is empty and only the base rule decides; equal labels of an id count once, with
one of the texts that carry the id (the smallest hash); null labels are left out. The sample is bounded by
`most_labels` (the pairs with the smallest hash of id and label) however often an id is repeated, everything
else runs over all rows. A text of any length is counted whole, in pieces; equal rows are judged alike; an empty
table gives an empty result. Columns named like a result are replaced, all others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetday.llm.common import one_per_label
from fleetday.llm.statistics import ratios, text_counts


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        x = table[self.feature]
        return x >= self.threshold if self.above else x < self.threshold

    def column(self) -> Column:
        x = F.col(self.feature)
        return x >= F.lit(self.threshold) if self.above else x < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]

#: Rates of defects only: long words or short texts are no defect by themselves.
FEATURES = ("symbols_per_word", "exclaims_per_word", "upper_share", "repeat_share", "same_next_share", "dup_line_share")


def features(of: str) -> dict[str, Column]:
    return {n: c for n, c in ratios(of).items() if n in FEATURES}


def _covered(rule: Rule, table: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for c in rule:
        hit &= c.holds(table)
    return hit


def _best_condition(table: dict[str, np.ndarray], bad: np.ndarray, hit: np.ndarray, cuts: int) -> tuple[float, Condition | None]:
    """The condition with the highest gain on the rows that the rule covers so far."""
    p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
    now = np.log2(max(p, 1) / max(p + n, 1))
    best: tuple[float, Condition | None] = (1e-9, None)
    for name, column in table.items():
        x, y = column[hit], bad[hit]
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        places = np.unique(np.linspace(0, len(x), cuts + 2).astype(int)[1:-1])
        places = np.concatenate([places, np.flatnonzero(np.diff(y.astype(np.int8))) + 1]) if len(x) < 4 * cuts else places
        marks = np.unique(x[np.clip(places, 0, len(x) - 1)])
        at = np.searchsorted(x, marks, "left")
        below_p = np.concatenate([[0], np.cumsum(y)])[at]
        for above, pos, size in ((True, p - below_p, len(x) - at), (False, below_p, at)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(pos > 0, pos * (np.log2(pos / np.maximum(size, 1)) - now), -1.0)
            i = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[i] > best[0]:
                # halfway to the next smaller value, so that the cut doesn't sit on a seen value
                lower = x[at[i] - 1] if at[i] else marks[i]
                best = (float(gain[i]), Condition(name, above, float((marks[i] + lower) / 2)))
    return best


def _worth(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> float:
    hit = _covered(rule, table, len(bad))
    p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(table: dict[str, np.ndarray], bad: np.ndarray, held_back: np.ndarray, precision: float = 0.97,
          least_share: float = 0.005, most_rules: int = 24, most_conditions: int = 5, cuts: int = 128) -> list[Rule]:
    """Rules for `bad` rows. `held_back` rows prune and judge a rule, the others grow it."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < most_rules:
        grow = {k: v[left & ~held_back] for k, v in table.items()}
        prune = {k: v[left & held_back] for k, v in table.items()}
        grow_bad, prune_bad = bad[left & ~held_back], bad[left & held_back]
        if not grow_bad.sum() or not prune_bad.sum():
            break
        rule: Rule = ()
        hit = np.ones(len(grow_bad), bool)
        while len(rule) < most_conditions and (~grow_bad[hit]).any():
            _, condition = _best_condition(grow, grow_bad, hit, cuts)
            if condition is None:
                break
            rule += (condition,)
            hit = _covered(rule, grow, len(grow_bad))
        while len(rule) > 1 and _worth(rule[:-1], prune, prune_bad) >= _worth(rule, prune, prune_bad):
            rule = rule[:-1]
        hit = _covered(rule, prune, len(prune_bad))
        right = int(prune_bad[hit].sum())
        if not rule or right < max(2, least_share * bad[held_back].sum()) or right < precision * hit.sum():
            break
        rules.append(rule)
        left &= ~_covered(rule, table, len(bad))
    return rules


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule that holds (from 1), else null, as one CASE over the features."""
    out: Column | None = None
    for i, rule in enumerate(rules, 1):
        condition = rule[0].column()
        for c in rule[1:]:
            condition &= c.column()
        out = F.when(condition, F.lit(i)) if out is None else out.when(condition, F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def labelled(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, most: int) -> DataFrame:
    """(doc_id, text, label) of at most `most` pairs of id and label, those with the smallest hash.

    The broadcast is bounded by `most` pairs of numbers and the result by `most` rows, whatever the size of the
    tables and however often they repeat an id.
    """
    key = F.xxhash64("_label_id", "_label")
    chosen = (
        labels.select(F.col(doc_id).alias("_label_id"), F.col(label).cast("int").alias("_label"))
        .where("_label in (0, 1) and _label_id is not null").distinct().orderBy(key, "_label_id", "_label").limit(most)
    )
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(chosen), F.col("_id") == F.col("_label_id")
    )
    return one_per_label(rows, ["_id", "_label"], "_text")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
        most_labels: int = 20_000, **options) -> list[Rule]:
    """The decision list for rows whose label is 0. Only numbers of the bounded sample reach the driver."""
    sample = labelled(docs, labels, label, doc_id, text, most_labels).withColumn("_c", text_counts(F.col("_text")))
    names = list(features("_c"))
    rows = sample.select("_id", "_label", *[c.alias(n) for n, c in features("_c").items()]).toPandas()
    if not len(rows):
        return []
    rows = rows.sort_values(["_id", "_label", *names])  # the same list whatever order the rows come in
    table = {n: rows[n].to_numpy(float) for n in names}
    held_back = (rows["_id"].to_numpy(np.int64) * 2654435761 % 2**32 // 2**10) % 3 == 0
    return learn(table, rows["_label"].to_numpy() == 0, held_back, **options)


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """`docs` with `_c` (counts), `base_failed`, `rule_no` (the rule that rejects, else null) and `kept`."""
    counted = docs.withColumn("_c", text_counts(F.col(text)))
    rates = features("_c")
    few = F.col("_c.n_words") < 20
    repeats = 100 * F.col("_c.n_repeat_words") > 30 * F.col("_c.n_words")
    return (
        counted.withColumns({f"_f_{n}": c for n, c in rates.items()})
        .withColumn("rule_no", decision([tuple(Condition(f"_f_{c.feature}", c.above, c.threshold) for c in r) for r in rules]))
        .withColumn("base_failed", few | repeats)
        .withColumn("kept", ~F.col("base_failed") & F.col("rule_no").isNull())
        .drop(*[f"_f_{n}" for n in rates])
    )
