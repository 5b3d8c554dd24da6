"""Quality rules: an ordered decision list learned from labelled text statistics.

Sequential covering: a rule is grown condition by condition (a threshold on one statistic, by
information gain) until it covers no good text, then pruned on held-out rows, then kept if it
is precise there; the texts it covers are taken away and the next rule is grown. The list is
emitted as one ordered Spark conditional expression.

Defined results: a null text counts as empty. An empty text has zero statistics and fails the
base rules. No labels, or labels of one kind only, give no rules. Repeated rows are judged each
for itself. Other columns, whatever their names, are kept and not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import ASCII_SPACE, once, text_bytes, unused

STATS = "quality_stats"

# Most labelled rows that the rules are fitted on: those first by a hash of their id.
MAX_LABELLED = 20_000

SYMBOLS = b"#*$%&|<>"

_COUNTS = (
    "n_words n_word_chars n_symbols n_dup_lines n_repeat_words "
    "n_lines n_upper n_lower n_digits n_marks n_distinct_words n_long_words"
).split()
STATS_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in _COUNTS) + ">"

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_MARKS = b"!?.,;:"
_CONTINUED = bytes(range(128, 192))  # bytes that do not begin a code point
_LINE_WORD = re.compile(rb"[^\x20\x09-\x0D]")


def _without(data: bytes, drop: bytes) -> int:
    """How many bytes of data are among drop."""
    return len(data) - len(data.translate(None, drop))


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text, first ones included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    count, covered = 0, 0  # covered: first word not yet counted
    for i, w in enumerate(windows):
        if seen[w] > 1:
            count += i + 3 - max(i, covered)
            covered = i + 3
    return count


def text_stats(data: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of _COUNTS."""
    words = data.split()
    lines = data.split(b"\n")
    with_words = [x for x in lines if _LINE_WORD.search(x)]
    return (
        len(words),
        len(data) - _without(data, ASCII_SPACE) - _without(data, _CONTINUED),
        _without(data, SYMBOLS),
        len(with_words) - len(set(with_words)),
        repeated_words(words),
        len(lines),
        _without(data, _UPPER),
        _without(data, _LOWER),
        _without(data, _DIGITS),
        _without(data, _MARKS),
        len(set(words)),
        sum(len(w) > 20 for w in words),
    )


def _stats(texts: pa.Array) -> pa.Array:
    rows = [text_stats(t) for t in texts.to_pylist()]
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(_COUNTS))]
    return pa.StructArray.from_arrays(columns, _COUNTS)


def with_stats(docs: DataFrame, text: str = "text", to: str = STATS) -> DataFrame:
    """docs with one more column, the struct of counts of the text."""
    return docs.withColumn(to, once(_stats, STATS_TYPE)(text_bytes(text)))


def _per(stats: Column, count: str, whole: str) -> Column:
    return stats[count] / F.greatest(stats[whole], F.lit(1))


def features(stats: str = STATS) -> dict[str, Column]:
    """The statistics that rules put thresholds on."""
    s = F.col(stats)
    return {
        "words": s["n_words"].cast("double"),
        "word_length": _per(s, "n_word_chars", "n_words"),
        "symbols_per_word": _per(s, "n_symbols", "n_words"),
        "dup_line_share": _per(s, "n_dup_lines", "n_lines"),
        "repeat_word_share": _per(s, "n_repeat_words", "n_words"),
        "words_per_line": _per(s, "n_words", "n_lines"),
        "upper_per_lower": _per(s, "n_upper", "n_lower"),
        "digit_share": _per(s, "n_digits", "n_word_chars"),
        "marks_per_word": _per(s, "n_marks", "n_words"),
        "distinct_share": _per(s, "n_distinct_words", "n_words"),
        "long_word_share": _per(s, "n_long_words", "n_words"),
    }


def base_failed(stats: str = STATS) -> Column:
    """Too short, or more than half of the words in repeated windows."""
    words, repeated = F.col(stats)["n_words"], F.col(stats)["n_repeat_words"]
    return (words < 50) | (100 * repeated > 50 * words)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        values = rows[self.feature]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self, stats: str = STATS) -> Column:
        value = features(stats)[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, rows: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, bool)
    for c in rule:
        held &= c.holds(rows)
    return held


def _best_condition(rows: dict[str, np.ndarray], bad: np.ndarray) -> Condition | None:
    """The threshold with the highest information gain for bad; ties: first feature, lowest."""
    p0, n0 = bad.sum(), (~bad).sum()
    before = np.log2(p0 / (p0 + n0))
    best, best_gain = None, 1e-9
    for name, values in rows.items():
        order = np.argsort(values, kind="stable")
        v, b = values[order], bad[order]
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        p_low, n_low = np.cumsum(b)[cuts], np.cumsum(~b)[cuts]
        for above, p, n in ((True, p0 - p_low, n0 - n_low), (False, p_low, n_low)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best_gain:
                cut = float((v[cuts[k]] + v[cuts[k] + 1]) / 2)
                # A middle that rounds up to the next value would not part the two.
                cut = cut if cut < v[cuts[k] + 1] else float(v[cuts[k]])
                best, best_gain = Condition(name, above, cut), float(gain[k])
    return best


def grow(rows: dict[str, np.ndarray], bad: np.ndarray, max_conditions: int) -> Rule:
    rule: Rule = ()
    held = np.ones(len(bad), bool)
    while len(rule) < max_conditions and bad[held].any() and not bad[held].all():
        found = _best_condition({k: v[held] for k, v in rows.items()}, bad[held])
        if found is None:
            break
        rule += (found,)
        held &= found.holds(rows)
    return rule


def prune(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drop final conditions while (bad - good) / (bad + good) on these rows does not fall."""
    best, best_worth = rule, -2.0
    for length in range(len(rule), 0, -1):
        held = _covers(rule[:length], rows, len(bad))
        p, n = bad[held].sum(), (~bad[held]).sum()
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth >= best_worth:
            best, best_worth = rule[:length], worth
    return best


def learn(
    rows: dict[str, np.ndarray],
    bad: np.ndarray,
    held_out: np.ndarray,
    min_precision: float = 0.95,
    min_covered: int = 3,
    max_conditions: int = 4,
    max_rules: int = 12,
) -> list[Rule]:
    """The decision list that tells bad texts from good ones."""
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < max_rules:
        g, h = left & ~held_out, left & held_out
        if not bad[g].any() or bad[g].all():
            break
        rule = grow({k: v[g] for k, v in rows.items()}, bad[g], max_conditions)
        if not rule:
            break
        rule = prune(rule, {k: v[h] for k, v in rows.items()}, bad[h])
        covered = _covers(rule, rows, len(bad)) & left
        right = bad[covered].sum()
        checked = covered & held_out
        if right < min_covered or right < min_precision * covered.sum():
            break
        if checked.any() and bad[checked].sum() < min_precision * checked.sum():
            break
        rules.append(rule)
        left &= ~covered
    return rules


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    max_labelled: int = MAX_LABELLED,
    **options,
) -> list[Rule]:
    """Learn from the labelled documents that pass the base rules; quality 0 is bad.

    Rows without a label, and ids with two different labels, are not used.
    """
    chosen = (
        labels.where(F.col(quality).isNotNull() & F.col(id).isNotNull())
        .groupBy(F.col(id).alias("_id"))
        .agg(F.min(quality).alias("_lo"), F.max(quality).alias("_hi"))
        .where("_lo = _hi")
        .select("_id", F.col("_lo").alias("_quality"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_labelled)
    )
    sample = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(chosen), "_id"  # at most max_labelled ids
    )
    sample = with_stats(sample, "_text").where(~base_failed())
    # One row per id, so that repeated documents keep the sample within its bound.
    columns = [F.min(c).alias(name) for name, c in features().items()]
    found = (
        sample.groupBy("_id")
        .agg(
            F.min("_quality").alias("_quality"),
            (F.xxhash64("_id") % 3 == 0).alias("_held"),
            *columns,
        )
        .orderBy("_id")
        .toPandas()
    )
    if not len(found):
        return []
    rows = {name: found[name].to_numpy(np.float64) for name in features()}
    bad = found["_quality"].to_numpy() == 0
    return learn(rows, bad, found["_held"].to_numpy(bool), **options)


def verdict(rules: list[Rule], stats: str = STATS) -> Column:
    """The first rule that fires, as text, or null: `CASE WHEN rule 1 THEN ... END`."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        held = F.lit(True)
        for c in rule:
            held = held & c.column(stats)
        out = F.when(held, F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def judged(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """docs with STATS, base_failed, rule (the one that fired) and kept."""
    return (
        with_stats(docs, text)
        .withColumn("base_failed", base_failed())
        .withColumn("rule", verdict(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def filtered(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The documents that the base rules and the list keep, with their own columns only."""
    stats = unused(docs, STATS)
    found = with_stats(docs, text, stats)
    return found.where(~base_failed(stats) & verdict(rules, stats).isNull()).drop(stats)
