"""Quality rules: word statistics of whole texts, and decision lists learned by sequential covering."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import map_rows

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: ASCII white space, as in the pattern of words.
BLANKS = " \t\n\x0b\x0c\r"

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words which occurs twice or more in the text, first ones included."""
    windows = list(zip(*(words[i:] for i in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    covered = bytearray(len(words))
    ones = b"\x01" * width
    for at, window in enumerate(windows):
        first = seen.setdefault(window, at)
        if first != at:
            covered[first : first + width] = ones
            covered[at : at + width] = ones
    return sum(covered)


def statistics_of(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of one text; all 0 for null."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def text_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The statistics of every whole text beside the columns in ``keep``.

    Words are runs of other than ASCII white space, which is how bytes split. A null or empty text has zeros;
    rows are independent of each other, so ties, repeated rows and empty tables need no care.
    """

    return map_rows(docs, keep, ["text"], dict.fromkeys(STATISTICS, "long"), lambda texts: [tuple(statistics_of(text)) for text in texts])


#: Interpretable ratios over the statistics, as SQL; rules are conjunctions of thresholds on these and on n_words.
RATIOS = {
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_lines_per_100_words": "100 * n_dup_lines / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
}
FEATURES = ["n_words", *RATIOS]


def with_ratios(statistics: DataFrame) -> DataFrame:
    return statistics.withColumns({name: F.expr(sql).cast("double") for name, sql in RATIOS.items()})


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, rows: pd.DataFrame) -> np.ndarray:
        values = rows[self.feature].to_numpy(dtype=float)
        return values >= self.threshold if self.at_least else values <= self.threshold

    def column(self) -> Column:
        value = F.col(self.feature).cast("double")
        return value >= self.threshold if self.at_least else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, rows: pd.DataFrame) -> np.ndarray:
    held = np.ones(len(rows), dtype=bool)
    for condition in rule:
        held &= condition.holds(rows)
    return held


def grow_rule(rows: pd.DataFrame, bad: np.ndarray, features: list[str], max_conditions: int, cuts: int) -> Rule:
    """Add the condition of the greatest information gain on what is still covered, until only bad rows are."""
    rule: list[Condition] = []
    inside = np.ones(len(rows), dtype=bool)
    while len(rule) < max_conditions and (inside & ~bad).any():
        here, here_bad = rows[inside], bad[inside]
        p0, n0 = here_bad.sum(), (~here_bad).sum()
        best, best_gain = None, 1e-9
        for feature in features:
            values = here[feature].to_numpy(dtype=float)
            order = np.argsort(values, kind="stable")
            ordered, hits = values[order], np.concatenate([[0], np.cumsum(here_bad[order])])
            edges = np.unique(np.quantile(ordered, np.linspace(0, 1, cuts), method="nearest"))
            for at_least in (True, False):
                if at_least:
                    first = np.searchsorted(ordered, edges, "left")
                    p, covered = p0 - hits[first], len(ordered) - first
                else:
                    last = np.searchsorted(ordered, edges, "right")
                    p, covered = hits[last], last
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / covered) - np.log2(p0 / (p0 + n0))), 0.0)
                k = int(np.argmax(gain))
                if gain[k] > best_gain:
                    best, best_gain = Condition(feature, at_least, float(edges[k])), float(gain[k])
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(rows)
    return tuple(rule)


def prune_rule(rule: Rule, rows: pd.DataFrame, bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule that is worth most, (bad - good) / covered, on rows it was not grown on."""
    best, best_worth = rule, -2.0
    for length in range(1, len(rule) + 1):
        held = covers(rule[:length], rows)
        worth = (2 * bad[held].sum() - held.sum()) / held.sum() if held.any() else -1.0
        if worth > best_worth + 1e-12:
            best, best_worth = rule[:length], worth
    return best


def learn_decision_list(
    rows: pd.DataFrame,
    bad: np.ndarray,
    features: list[str],
    min_precision: float = 0.95,
    min_covered: int = 10,
    max_rules: int = 16,
    max_conditions: int = 4,
    cuts: int = 128,
) -> list[Rule]:
    """Rules that reject, in order, by sequential covering: grow one on two thirds, prune it on a third, take out what it covers.

    A rule stays only if it covers ``min_covered`` of all labelled rows that are left and at least ``min_precision`` of
    those are bad; the first that doesn't ends the list. What no rule covers is kept. No rows or no bad rows: no rules.
    """
    rows, bad = rows.reset_index(drop=True), np.asarray(bad, dtype=bool)
    learned: list[Rule] = []
    third = np.arange(len(rows)) % 3 == 2
    left = np.ones(len(rows), dtype=bool)
    while len(learned) < max_rules and (left & bad & ~third).any():
        growing, pruning = left & ~third, left & third
        rule = grow_rule(rows[growing], bad[growing], features, max_conditions, cuts)
        if not rule:
            break
        rule = prune_rule(rule, rows[pruning], bad[pruning])
        held = covers(rule, rows) & left
        if held.sum() < min_covered or bad[held].mean() < min_precision:
            break
        learned.append(rule)
        left &= ~held
    return learned


def decision_column(rules: list[Rule]) -> Column:
    """One ordered conditional expression: the number, from 1, of the first rule that holds; 0 where none does."""
    verdict: Column | None = None
    for number, rule in enumerate(rules, 1):
        held = rule[0].column()
        for condition in rule[1:]:
            held = held & condition.column()
        verdict = F.when(held, F.lit(number)) if verdict is None else verdict.when(held, F.lit(number))
    return F.lit(0) if verdict is None else verdict.otherwise(F.lit(0))


def fit_quality_rules(statistics: DataFrame, labels: DataFrame, max_labelled: int = 20_000, **how) -> list[Rule]:
    """Learn from labelled rows (quality 0 is bad); at most ``max_labelled`` of them, chosen by a hash of doc_id."""
    labelled = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality")
    sample = (
        with_ratios(statistics).select("doc_id", *FEATURES).join(labelled, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *FEATURES).limit(max_labelled).toPandas()
    )
    return learn_decision_list(sample[FEATURES].astype(float), sample["quality"].to_numpy() == 0, FEATURES, **how)


def apply_quality_rules(statistics: DataFrame, rules: list[Rule], base_failed: Column) -> DataFrame:
    """Adds base_failed, rule (number of the learned rule that rejects, else 0) and kept."""
    judged = with_ratios(statistics).withColumn("base_failed", base_failed).withColumn("rule", decision_column(rules)).drop(*RATIOS)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
