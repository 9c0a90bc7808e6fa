"""Quality rules: base statistics and a learned decision list.

Statistics of the whole text are counted once per row. From those of labelled documents, sequential covering grows
conjunctions of thresholds that find rejected documents, prunes them on rows kept apart, and keeps a rule while it is
precise there. The list becomes one ordered conditional expression over the statistics.

NULL texts have no words, and so fail. Repeated rows are judged each. Without labelled rows the list is empty and
accepts; an empty table gives no rows; extra columns are ignored. Rows without doc_id are judged but not learnt from.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, hash_order, texts

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_letters", "n_upper", "n_digits", "n_marks", "n_distinct", "n_chars")
COUNTED = "doc_id long, " + ", ".join(f"{name} long" for name in (*BASE, *MORE))
SYMBOLS, MARKS = b"#*$%&|<>", b"!?.,;:"

# The limits of the base rules.
LEAST_WORDS, MOST_REPEATED_PERCENT = 10, 20

#: Fitting sample: most labelled documents that are learnt from. Then the shape of the list.
LABELLED = 20_000
MOST_RULES, MOST_CONDITIONS, CUTS, PRECISION = 12, 4, 40, 0.95
FOLDS = 5

#: Shares that conditions are about, as (name, counted, per).
SHARES = (
    ("symbol_share", "n_symbols", "n_chars"), ("dup_line_share", "n_dup_lines", "n_lines"),
    ("repeat_share", "n_repeat_words", "n_words"), ("mean_word", "word_chars", "n_words"),
    ("upper_share", "n_upper", "n_letters"), ("digit_share", "n_digits", "n_chars"), ("mark_share", "n_marks", "n_chars"),
    ("distinct_share", "n_distinct", "n_words"), ("words_per_line", "n_words", "n_lines"), ("words", "n_words", None),
)


def counted(text: str | None) -> tuple[int, ...]:
    """The statistics in the order of BASE and MORE."""
    if not text:
        return (0,) * len(BASE + MORE)
    body = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(np.frombuffer(body, "uint8"), minlength=256)
    words = body.split()
    n_space = int(kinds[[9, 10, 11, 12, 13, 32]].sum())
    lines = [x for x in body.split(b"\n") if x and not x.isspace()]
    upper, lower = int(kinds[65:91].sum()), int(kinds[97:123].sum())
    return (
        len(words), len(text) - n_space, int(kinds[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), upper + lower, upper, int(kinds[48:58].sum()), int(kinds[list(MARKS)].sum()), len(set(words)), len(text),
    )


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words in windows that occur more than once."""
    windows = list(zip(*(words[k:] for k in range(size))))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    step = np.zeros(len(words) + 1, "int64")
    at = np.flatnonzero(np.fromiter((times[w] > 1 for w in windows), bool, len(windows)))
    np.add.at(step, at, 1)
    np.add.at(step, at + size, -1)
    return int((np.cumsum(step) > 0).sum())


def statistics(docs: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = pd.DataFrame([counted(t) for t in frame["text"]], columns=[*BASE, *MORE])
            rows.insert(0, "doc_id", frame["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None))
            yield rows

    return texts(docs).mapInPandas(run, COUNTED)


@dataclass(frozen=True)
class Condition:
    share: int
    above: bool
    cut: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.share] >= self.cut if self.above else x[:, self.share] <= self.cut

    def column(self) -> Column:
        value = share_columns()[self.share]
        return value >= F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{SHARES[self.share][0]} {'>=' if self.above else '<='} {self.cut:.6g}"


def share_columns() -> list[Column]:
    return [F.col(a).cast("double") if b is None else F.col(a) / F.greatest(F.col(b), F.lit(1)) for _, a, b in SHARES]


def holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def grow(x: np.ndarray, bad: np.ndarray) -> tuple[Condition, ...]:
    """Adds the condition with the largest information gain until no accepted row is covered."""
    rule: tuple[Condition, ...] = ()
    inside = np.ones(len(x), bool)
    while len(rule) < MOST_CONDITIONS and (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        if not p:
            break
        before, best = np.log2(p / (p + n)), (0.0, None)
        for share in range(x.shape[1]):
            values = x[inside, share]
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, CUTS)))
            cuts = (cuts[1:] + cuts[:-1]) / 2
            order = np.sort(values[bad[inside]]), np.sort(values[~bad[inside]])
            low = [np.searchsorted(o, cuts, "right") for o in order]
            for above in (True, False):
                pos = p - low[0] if above else low[0]
                neg = n - low[1] if above else low[1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / (pos + neg)) - before), 0.0)
                if len(gain) and gain.max() > best[0] + 1e-9:
                    best = (float(gain.max()), Condition(share, above, float(cuts[gain.argmax()])))
        if best[1] is None:
            break
        rule = (*rule, best[1])
        inside &= best[1].holds(x)
    return rule


def worth(rule: tuple[Condition, ...], x: np.ndarray, bad: np.ndarray) -> float:
    inside = holds(rule, x)
    p, n = (inside & bad).sum(), (inside & ~bad).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learn_list(x: np.ndarray, bad: np.ndarray, aside: np.ndarray) -> list[tuple[Condition, ...]]:
    """Rules for rejected rows, in order; `aside` names the rows that only prune and judge."""
    rules: list[tuple[Condition, ...]] = []
    left = np.ones(len(x), bool)
    while len(rules) < MOST_RULES:
        growing, judging = left & ~aside, left & aside
        if (growing & bad).sum() < 3:
            break
        rule = grow(x[growing], bad[growing])
        shorter = [rule[:k] for k in range(len(rule), 0, -1)]
        if not shorter:
            break
        rule = max(shorter, key=lambda r: worth(r, x[judging], bad[judging]))
        inside = holds(rule, x) & judging
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        if (p + 1) / (p + n + 1) < PRECISION or not p:
            break
        rules.append(rule)
        left &= ~holds(rule, x)
    return rules


def verdict(rules: list[tuple[Condition, ...]]) -> Column:
    """The list as one ordered conditional expression: the first rule that holds rejects."""
    out = None
    for rule in rules:
        condition = rule[0].column()
        for more in rule[1:]:
            condition = condition & more.column()
        out = F.when(condition, False) if out is None else out.when(condition, False)
    return F.lit(True) if out is None else out.otherwise(True)


def train(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> list[tuple[Condition, ...]]:
    """Learns from labelled documents outside the fold that is held out for measuring."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != 0))
    drawn = usable.select("doc_id", "quality").distinct().orderBy(hash_order(F.col("doc_id")), "doc_id", "quality").limit(most)
    drawn = drawn.toPandas()
    if drawn.empty:
        return []
    few = docs.sparkSession.createDataFrame(drawn[["doc_id"]].drop_duplicates())  # at most `most` ids
    rows = statistics(texts(docs).join(F.broadcast(few), "doc_id")).select("doc_id", *[c.alias(s[0]) for c, s in zip(share_columns(), SHARES)])
    rows = rows.toPandas().merge(drawn, on="doc_id").sort_values(["doc_id", "quality", "words"], kind="stable")
    x = rows[[s[0] for s in SHARES]].to_numpy("float64")
    return learn_list(x, rows["quality"].to_numpy() == 0, rows["doc_id"].to_numpy() % 3 == 0)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rules = train(docs, labels)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    counts = statistics(docs)
    return counts.select("doc_id", *BASE, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
