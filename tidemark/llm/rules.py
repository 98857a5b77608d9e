"""Learned quality rules: an ordered list of threshold conjunctions.

Sequential covering on labelled statistics. A rule for low quality is grown
condition by condition (best information gain on the growing rows), pruned from
its end (on rows it was not grown on), and accepted while it is precise enough
there; the rows it covers leave, and the next rule is learned on the rest. The
list becomes one Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashed_sample, table
from tidemark.llm.textstats import BASE, add_counts, filter_by_counts
from tidemark.plans.scratch import materialize

# Statistic: (count, count it is divided by); an empty divisor counts as one.
RATIOS = {
    "words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "distinct_share": ("n_distinct", "n_words"),
    "top_word_share": ("n_top_word", "n_words"),
    "upper_share": ("n_upper", "n_letters"),
    "digits_per_word": ("n_digits", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "ended_share": ("n_ended", "n_words"),
}


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        v = values[self.name]
        return v >= self.threshold if self.above else v < self.threshold

    def column(self) -> Column:
        v = statistic(self.name)
        return v >= self.threshold if self.above else v < self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def statistic(name: str) -> Column:
    over, under = RATIOS[name]
    value = F.col(over).cast("double")
    return value / F.greatest(F.col(under), F.lit(1)) if under else value


def _covers(rule: Rule, values: dict[str, np.ndarray], size: int) -> np.ndarray:
    out = np.ones(size, bool)
    for c in rule:
        out &= c.holds(values)
    return out


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray, cuts: int) -> tuple[Condition | None, np.ndarray]:
    """The condition with the largest gain p1 * (log p1/(p1+n1) - log p0/(p0+n0))."""
    p0, n0 = bad.sum(), (~bad).sum()
    best, found, mask = 1e-9, None, bad
    for name in sorted(values):
        v = values[name]
        for cut in np.unique(np.quantile(v, np.linspace(0, 1, cuts))):
            above = v >= cut
            for side in (True, False):
                inside = above if side else ~above
                p1 = (inside & bad).sum()
                n1 = inside.sum() - p1
                if not p1 or n1 == n0:
                    continue
                gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p0 / (p0 + n0)))
                if gain > best:
                    best, found, mask = gain, Condition(name, side, float(cut)), inside
    return found, mask


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, cuts: int, longest: int) -> Rule:
    rule: list[Condition] = []
    while len(rule) < longest and not bad.all():
        condition, inside = _best_condition(values, bad, cuts)
        if condition is None:
            break
        rule.append(condition)
        values = {k: v[inside] for k, v in values.items()}
        bad = bad[inside]
    return tuple(rule)


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The prefix of the rule with the best (p - n) / (p + n), its precision and cover."""
    best: tuple[float, Rule, float, int] = (-2.0, (), 0.0, 0)
    for end in range(1, len(rule) + 1):
        inside = _covers(rule[:end], values, len(bad))
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[0]:
            best = (worth, rule[:end], p / (p + n) if p + n else 0.0, p)
    return best[1], best[2], best[3]


def learn(
    values: dict[str, np.ndarray],
    bad: np.ndarray,
    precision: float = 0.97,
    least: int = 3,
    cuts: int = 65,
    longest: int = 4,
    most_rules: int = 24,
    seed: int = 7,
) -> list[Rule]:
    """Rules for rows where ``bad`` holds, in order; none if there is nothing to learn."""
    part = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    rules: list[Rule] = []
    alive, misses = np.ones(len(bad), bool), 0
    while len(rules) < most_rules and misses < 2:
        grow, prune = alive & part, alive & ~part
        if not (grow & bad).any() or not (prune & bad).any():
            break
        rule = _grow({k: v[grow] for k, v in values.items()}, bad[grow], cuts, longest)
        rule, right, cover = _prune(rule, {k: v[prune] for k, v in values.items()}, bad[prune])
        if not rule or right < precision or cover < least:
            # Another split of the rows may still find one.
            misses += 1
            part = np.random.default_rng(seed + misses + len(rules)).random(len(bad)) < 2 / 3
            continue
        misses = 0
        rules.append(rule)
        alive &= ~_covers(rule, values, len(bad))
    return rules


def reject_rule(rules: list[Rule]) -> Column:
    """Number of the first rule that holds (from 1), 0 if none does."""
    out: Column | None = None
    for i, rule in enumerate(rules, 1):
        holds = rule[0].column()
        for c in rule[1:]:
            holds &= c.column()
        out = F.when(holds, i) if out is None else out.when(holds, i)
    return F.lit(0) if out is None else out.otherwise(0)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit_rules(counts: DataFrame, labels: DataFrame, key: str = "doc_id", sample: int = 20_000, **options) -> list[Rule]:
    """Learn from at most ``sample`` labelled rows, the first by a hash of their key.

    ``labels`` has ``key`` and ``quality`` (1 good, 0 low; null rows are unlabelled).
    Rows that fail the fixed base rules are left to those.
    """
    labelled = labels.where("quality IS NOT NULL").groupBy(key).agg(F.min("quality").alias("_quality"))
    rows = (
        counts.where(~base_failed())
        .join(labelled, key)
        .select(key, *[statistic(n).alias(n) for n in RATIOS], "_quality")
    )
    rows = hashed_sample(materialize(rows, "labelled"), key, sample).toPandas()
    if rows.empty:
        return []
    values = {n: rows[n].to_numpy(float) for n in RATIOS}
    return learn(values, (rows["_quality"] == 0).to_numpy(), **options)


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **options) -> tuple[DataFrame, list[Rule]]:
    """One row per document: ``key``, all counts, ``base_failed``, ``rule`` (0: none) and ``kept``.

    Null and empty texts have counts of 0 and fail the base rules. A null key is a
    row like any other; repeated rows are judged one by one. Without labelled rows
    the list is empty and the base rules decide. Other columns of ``docs`` are not read.
    """
    counts = materialize(add_counts(docs, key), "quality-counts")
    rules = fit_rules(counts, labels, key, **options)
    judged = counts.withColumns({"base_failed": base_failed(), "rule": reject_rule(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)), rules


def filter_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The documents that neither the base rules nor the learned list reject, with all their columns.

    The list is learned first; then every text is judged where it lies, so texts are not shuffled."""
    counts = materialize(add_counts(docs, key), "quality-counts")
    rules = fit_rules(counts, labels, key, **options)
    return filter_by_counts(docs, ~base_failed() & (reject_rule(rules) == 0))


def rules_query(spark, folder: str) -> DataFrame:
    judged, _ = judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", *BASE, "base_failed", "kept", "rule")
