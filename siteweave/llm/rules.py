"""Quality rules: learned decision lists over text statistics, emitted as ordered Spark conditional expressions.

Statistics are counted over each whole text. A list of rules, each a conjunction of thresholds, is learned by sequential
covering: a rule is grown on two thirds of the labelled rows, condition by condition, for the largest information gain
about rejected rows; its last conditions are pruned while that raises its worth on the other third; the rows it covers
leave, and the next rule is grown, until no rule is good enough. What no rule covers is kept.

Defined results: null text has no words and fails the base rule; rows are judged one by one, so repeated rows get equal
verdicts; without labelled rows of both classes the list is empty and the base rule alone decides; labels that contradict
each other count as 0; null ids are never labelled; an empty table gives an empty table. ``keep_good`` returns the columns
of ``docs`` under any names; ``judge`` puts its three columns in the place of columns that are called so.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.llm.common import WHITE, packed
from siteweave.recovery import handed_back

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: The base rule: fewer words than this, or more than this share of words in repeated windows, fails.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: At most so many labelled rows are learned from, those with the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
#: A rule must be right for this share of the rows it covers in the pruning part, and cover so many in the growing part.
LEAST_PRECISION, LEAST_COVER = 0.9, 8
MOST_CONDITIONS, MOST_RULES = 4, 12

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines", "n_distinct"]
#: What the thresholds are about, as expressions over the statistics.
FEATURES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "repeated_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
}


def text_statistics(text: str | None) -> tuple[int, ...]:
    """The figures named in ``STATISTICS`` for one text."""
    text = text or ""
    words = text.encode().split()  # bytes split at space and the control characters 9 to 13
    n = len(words)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(windows) > len(set(windows)):
        found = Counter(windows)
        end = 0  # words before it are counted
        for at, window in enumerate(windows):
            if found[window] > 1:
                repeated += at + 3 - max(at, end)
                end = at + 3
    seen, dup, lines = set(), 0, text.split("\n")
    for line in lines:
        if line in seen:
            dup += bool(line.strip(WHITE))
        else:
            seen.add(line)
    upper = sum(map(str.isupper, text)) if not text.isascii() else len(text) - len(text.translate(_NO_CAPITALS))
    return (
        n, len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), dup, repeated,
        upper, text.count("!") + text.count("?"), len(lines), len(set(words)),
    )


_NO_CAPITALS = dict.fromkeys(range(ord("A"), ord("Z") + 1))


def statistics_column(text: Column) -> Column:
    """struct of the ``STATISTICS`` of each text, as long."""

    @F.pandas_udf(", ".join(f"{name} long" for name in STATISTICS))
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([text_statistics(t) for t in texts], columns=STATISTICS, index=texts.index, dtype="int64")
        handed_back()

    return counted(text)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        return rows[self.feature] >= self.threshold if self.above else rows[self.feature] <= self.threshold

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>=' if self.above else '<='} {self.threshold!r}D"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; each is a conjunction whose rows are rejected. Rows that none covers are kept."""

    rules: tuple[tuple[Condition, ...], ...] = field(default=())

    def sql(self) -> str:
        whens = " ".join(f"WHEN {' AND '.join(c.sql() for c in rule)} THEN false" for rule in self.rules)
        return f"CASE {whens} ELSE true END" if self.rules else "true"

    def column(self) -> Column:
        return F.expr(self.sql())


def _cover(rule: tuple[Condition, ...], rows: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, bool)
    for condition in rule:
        held &= condition.holds(rows)
    return held


def _best_condition(rows: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold with the largest gain: covered bad rows times the bits that their share rises by."""
    base = np.log2(bad.mean())
    best, found = 1e-9, None
    for name in FEATURES:
        order = np.argsort(rows[name], kind="stable")
        value, hits = rows[name][order], np.cumsum(bad[order])
        cuts = np.flatnonzero(np.diff(value) > 0)
        if not len(cuts):
            continue
        below, n_below = hits[cuts], cuts + 1
        for above, p, n in ((False, below, n_below), (True, hits[-1] - below, len(value) - n_below)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((p > 0) & (n >= LEAST_COVER), p * (np.log2(p / n) - base), 0)
            at = int(np.argmax(gain))
            if gain[at] > best:
                middle = float(f"{(value[cuts[at]] + value[cuts[at] + 1]) / 2:.6g}")
                if not value[cuts[at]] < middle < value[cuts[at] + 1]:
                    middle = float(value[cuts[at] + 1] if above else value[cuts[at]])
                best, found = gain[at], Condition(name, above, middle)
    return best, found


def _tightest(rule: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """Without conditions that a later one on the same feature and side makes needless."""
    return tuple(c for k, c in enumerate(rule) if not any((d.feature, d.above) == (c.feature, c.above) for d in rule[k + 1 :]))


def learn(table: pd.DataFrame) -> DecisionList:
    """From rows of FEATURES and ``quality`` (1 good, 0 bad), in their order: every third row is for pruning."""
    bad = (table["quality"].to_numpy() == 0).astype(np.int64)
    columns = {name: table[name].to_numpy(np.float64) for name in FEATURES}
    prune = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < MOST_RULES:
        grow = left & ~prune
        if not 0 < bad[grow].sum() < grow.sum():
            break
        part = {k: v[grow] for k, v in columns.items()}
        own, rule = bad[grow], ()
        while len(rule) < MOST_CONDITIONS and 0 < own.sum() < len(own):
            _, condition = _best_condition(part, own)
            if condition is None:
                break
            held = condition.holds(part)
            part, own, rule = {k: v[held] for k, v in part.items()}, own[held], (*rule, condition)
        test = left & prune
        rest = {k: v[test] for k, v in columns.items()}

        def worth(some: tuple[Condition, ...], rest=rest, test=test) -> float:
            held = _cover(some, rest, int(test.sum()))
            return (2 * bad[test][held].sum() - held.sum()) / max(1, held.sum())

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        if not rule:
            break
        rule = _tightest(rule)
        held = _cover(rule, rest, int(test.sum()))
        grown = _cover(rule, columns, len(bad)) & grow
        precise = min(bad[grown].mean() if grown.any() else 0, bad[test][held].mean() if held.any() else bad[grown].mean())
        if precise < LEAST_PRECISION or bad[grown].sum() < LEAST_COVER:
            break
        rules.append(rule)
        left &= ~_cover(rule, columns, len(bad))
    return DecisionList(tuple(rules))


def labelled_sample(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, quality): at most ``rows`` labelled ids, those whose hashes come first; a bounded table."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DecisionList:
    """A decision list from the labelled rows of ``docs``; the driver gets one row of figures for each, at most ``rows``."""
    sample = F.broadcast(labelled_sample(labels, rows))  # bounded by ``rows``
    held = docs.select("doc_id", "text").join(sample, "doc_id")
    held = held.select("doc_id", "quality", statistics_column(F.col("text")).alias("s")).select("doc_id", "quality", "s.*")
    held = held.select("doc_id", "quality", *[F.expr(f"CAST({e} AS DOUBLE)").alias(name) for name, e in FEATURES.items()])
    # ids may repeat: of their rows, too, only the first ``rows`` come to the driver
    figures = held.orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(rows).toPandas()
    return learn(figures.sort_values(["doc_id", *FEATURES]).sample(frac=1, random_state=5).reset_index(drop=True))


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``docs`` with ``__stats`` (struct of the statistics), ``__base_failed`` and ``__kept``."""
    held = docs.withColumn("__stats", statistics_column(F.col("text")))
    n, again = F.col("__stats.n_words"), F.col("__stats.n_repeat_words")
    failed = (n < LEAST_WORDS) | (100 * again > MOST_REPEATED * n)
    verdict = rules.sql()
    for name in sorted(STATISTICS, key=len, reverse=True):
        verdict = verdict.replace(f"({name} ", f"(__stats.{name} ").replace(f"greatest({name},", f"greatest(__stats.{name},")
    return held.withColumn("__base_failed", failed).withColumn("__kept", ~failed & F.expr(verdict))


def keep_good(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the list."""
    return judge(packed(docs).select("doc", "doc.text"), rules).where("__kept").select("doc.*")
