"""Text quality by a sparse rule ensemble: tree paths as rules, lasso weights, Spark columns.

Statistics of whole texts are Spark expressions. Small boosted trees are grown on a bounded
sample of labelled rows; every path of theirs is a conjunctive rule; logistic regression with
an L1 penalty weighs the rules and leaves few. The rules become one column expression, so
that scoring all documents is a single scan without Python.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LEAF_ROWS = 16, 3, 32, 0.4, 20
PENALTIES = (0.03, 0.01, 0.003, 0.001)
HELD_FOLD, FOLDS = 1, 3

STATISTICS = (
    "chars", "words", "word_chars", "upper", "symbols", "bangs", "bars", "digits", "ends", "lines", "distinct_words", "distinct_lines",
    "commas", "letters",
)


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def bound(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, wherever the optimizer moves the expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def statistics(text: Column) -> Column:
    """Struct of the statistics of a whole text, as doubles; a null text is empty."""
    text = F.coalesce(text, F.lit(""))

    def of(t: Column) -> Column:
        size = F.length(t)
        share = lambda rest: (size - F.length(rest)) / F.greatest(size, F.lit(1))
        without = lambda pattern: F.regexp_replace(t, pattern, "")
        words = bound(F.split(t, " "), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
        lines = bound(F.split(t, "\n"), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
        values = {
            "chars": F.log1p(size),
            "words": F.log1p(words["n"]),
            "word_chars": size / words["n"],
            "upper": share(without(r"\p{Lu}+")),
            "symbols": share(without(r"[#$%&*^~=<>{}\[\]\\@_+/]+")),
            "bangs": share(F.replace(t, F.lit("!"), F.lit(""))),
            "bars": share(F.replace(t, F.lit("|"), F.lit(""))),
            "digits": share(without(r"[0-9]+")),
            "ends": share(F.replace(t, F.lit("."), F.lit(""))),
            "lines": lines["n"] / F.greatest(size, F.lit(1)),
            "distinct_words": words["d"] / words["n"],
            "distinct_lines": lines["d"] / lines["n"],
            "commas": share(F.replace(t, F.lit(","), F.lit(""))),
            "letters": share(without(r"\p{L}+")),
        }
        return F.struct(*[values[name].cast("double").alias(name) for name in STATISTICS])

    return bound(text, of)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, below, threshold): `<=` where below, else `>`."""

    conditions: tuple[tuple[int, bool, float], ...]

    def holds(self, values: np.ndarray) -> np.ndarray:
        held = np.ones(len(values), dtype=bool)
        for place, below, limit in self.conditions:
            held &= (values[:, place] <= limit) == below
        return held

    def column(self, stats: Column) -> Column:
        held = F.lit(True)
        for place, below, limit in self.conditions:
            value = stats[STATISTICS[place]]
            held = held & (value <= F.lit(limit) if below else value > F.lit(limit))
        return held


@dataclass
class RuleModel:
    """Weighted rules over the statistics; without any, every text scores what `intercept` says."""

    intercept: float = 0.0
    rules: list[tuple[float, Rule]] = field(default_factory=list)

    def score(self, text: Column) -> Column:
        """Probability of good quality as one column expression."""

        def of(stats: Column) -> Column:
            total = F.lit(float(self.intercept))
            for weight, rule in self.rules:
                total = total + F.when(rule.column(stats), F.lit(float(weight))).otherwise(F.lit(0.0))
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

        return bound(statistics(text), of)


def grow(values: np.ndarray, binned: np.ndarray, limits: list[np.ndarray], gradient: np.ndarray, curvature: np.ndarray):
    """One tree by second-order gains: (conditions, rows, value) of every node below the root."""
    nodes, found = [((), np.arange(len(values)))], []
    for depth in range(DEPTH + 1):
        following = []
        for conditions, rows in nodes:
            value = -gradient[rows].sum() / (curvature[rows].sum() + 1.0)
            best = (1e-6, None)
            if depth < DEPTH and len(rows) >= 2 * LEAF_ROWS:
                total_g, total_h = gradient[rows].sum(), curvature[rows].sum()
                for place, edges in enumerate(limits):
                    if not len(edges):
                        continue
                    codes = binned[rows, place]
                    g = np.bincount(codes, gradient[rows], len(edges) + 1).cumsum()[:-1]
                    h = np.bincount(codes, curvature[rows], len(edges) + 1).cumsum()[:-1]
                    n = np.bincount(codes, minlength=len(edges) + 1).cumsum()[:-1]
                    gains = g**2 / (h + 1.0) + (total_g - g) ** 2 / (total_h - h + 1.0) - total_g**2 / (total_h + 1.0)
                    gains[(n < LEAF_ROWS) | (len(rows) - n < LEAF_ROWS)] = -1.0
                    at = int(gains.argmax())
                    if gains[at] > best[0]:
                        best = (gains[at], (place, at))
            leaf = best[1] is None
            if conditions:
                found.append((conditions, rows, value, leaf))
            if not leaf:
                place, at = best[1]
                left = binned[rows, place] <= at
                limit = float(limits[place][at])
                following += [(conditions + ((place, True, limit),), rows[left]), (conditions + ((place, False, limit),), rows[~left])]
        nodes = following
    return found


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def lasso(rules: np.ndarray, labels: np.ndarray, penalty: float, rounds: int = 300) -> tuple[float, np.ndarray]:
    """Intercept and weights of logistic regression with an L1 penalty, by accelerated proximal steps."""
    n, k = rules.shape
    step = 4.0 * n / (np.linalg.norm(np.column_stack([rules, np.ones(n, np.float32)]), 2) ** 2 + 1e-9)
    weights, bias = np.zeros(k), float(np.log((labels.mean() + 1e-3) / (1 - labels.mean() + 1e-3)))
    ahead, ahead_bias, pace = weights.copy(), bias, 1.0
    for _ in range(rounds):
        error = sigmoid(rules @ ahead + ahead_bias) - labels
        moved = ahead - step * (rules.T @ error) / n
        moved = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0.0)
        moved_bias = ahead_bias - step * error.mean()
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = moved + (pace - 1) / faster * (moved - weights)
        ahead_bias = moved_bias + (pace - 1) / faster * (moved_bias - bias)
        weights, bias, pace = moved, moved_bias, faster
    return bias, weights


def fit_rules(values: np.ndarray, labels: np.ndarray) -> RuleModel:
    """The model of a sample in memory: (rows, statistics) and 0/1 labels; rows in any order."""
    if len(labels) == 0:
        return RuleModel()
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    base = float(np.log(share / (1 - share)))
    if labels.min() == labels.max():
        return RuleModel(base)
    limits = [np.unique(np.quantile(values[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(values.shape[1])]
    binned = np.column_stack([np.searchsorted(edges, values[:, j]) for j, edges in enumerate(limits)])
    margin, rules = np.full(len(labels), base), {}
    for _ in range(TREES):
        chance = sigmoid(margin)
        for conditions, rows, value, leaf in grow(values, binned, limits, chance - labels, chance * (1 - chance)):
            rules.setdefault(Rule(conditions), None)
            if leaf:
                margin[rows] += RATE * value
    kept = list(rules)
    matrix = np.column_stack([rule.holds(values) for rule in kept]).astype(np.float32)
    checked = np.arange(len(labels)) % 5 == 0
    best = None
    for penalty in PENALTIES:
        bias, weights = lasso(matrix[~checked], labels[~checked], penalty)
        chance = np.clip(sigmoid(matrix[checked] @ weights + bias), 1e-6, 1 - 1e-6)
        loss = -np.mean(np.where(labels[checked] == 1, np.log(chance), np.log(1 - chance)))
        if best is None or loss < best[0] - 1e-4:
            best = (loss, penalty)
    bias, weights = lasso(matrix, labels, best[1])
    return RuleModel(float(bias), [(float(w), rule) for w, rule in zip(weights, kept) if abs(w) > 1e-6])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> RuleModel:
    """A model of at most `sample_rows` labelled rows outside the held-out fold.

    The sample is drawn by a hash of the id, whatever the order of rows. Only its ids, bounded
    by `sample_rows`, are broadcast, and only its statistics reach the driver: of texts that
    share an id and label those of one, the least. Rows without label or id don't count; without
    labelled rows every score is 0.5.
    """
    chosen = (
        labels.select(F.col(id_column).cast("long").alias("label_id"), F.col(label_column).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & (fold_of(F.col("label_id")) != HELD_FOLD))
        .orderBy(F.xxhash64("label_id", F.lit(5)), "label_id", "label")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(id_column).cast("long").alias("label_id"), F.col(text_column).alias("text"))
    rows = texts.join(F.broadcast(chosen), "label_id").select("label_id", "label", statistics(F.col("text")).alias("stats"))
    rows = rows.groupBy("label_id", "label").agg(F.min("stats").alias("stats"))
    sample = rows.select("label_id", "label", "stats.*").toPandas().sort_values(["label_id", "label", "chars"])
    mixed = np.random.default_rng(5).permutation(len(sample))
    return fit_rules(sample[list(STATISTICS)].to_numpy(float)[mixed], sample["label"].to_numpy(float)[mixed])


def scored(docs: DataFrame, model: RuleModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; a null text is empty, a null id in no fold.

    Repeated rows stay, an empty table gives no rows, and other columns are not read.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(fold_of(F.col(id_column)) == HELD_FOLD, F.lit(False)).alias("held_out"),
        model.score(F.col(text_column)).alias("score"),
    )
    return rows.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def good(docs: DataFrame, model: RuleModel, text_column: str = "text") -> DataFrame:
    """The rows of `docs` that score 0.5 or more, with all their columns.

    A null text is scored as an empty one, ids aren't looked at, repeated rows stay or go
    together, and an empty table gives no rows.
    """
    return docs.where(model.score(F.col(f"`{text_column}`")) >= 0.5)
