"""Quality classifier: a sparse rule ensemble (Friedman and Popescu 2008).

Small trees over statistics of the text give rules: the conditions on the way to each node. A logistic
model with the lasso penalty weighs the rules, most of them with zero; the others become one Spark
column expression over the statistics.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import free_name, written
from riskstream.llm.labelled import held_out, labelled_sample

FOLDS, FOLD, CUT = 5, 0, 0.3
#: Trees and depth of the forest that proposes rules, share of rows and of statistics a tree sees, and the penalty.
TREES, DEPTH, ROWS, PENALTY = 24, 3, 0.5, 0.001

STATISTICS = ("words", "word_length", "distinct_share", "repeat_share", "top_word_share", "symbol_share", "pipe_share",
              "digit_share", "upper_share", "space_share", "end_share", "lines", "line_words", "line_repeat_share",
              "short_line_share", "pair_repeat_share", "ended_line_share")

Rule = tuple[tuple[int, str, float], ...]

_CLASS = np.zeros(256, dtype=np.int64)  # of bytes: 0 letters, 1 symbols, 2 digits, 3 upper case, 4 blanks
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 1
_CLASS[48:58], _CLASS[65:91], _CLASS[[9, 10, 11, 12, 13, 32]] = 2, 3, 4


def text_statistics(text: str) -> list[float]:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    seen = np.bincount(data, minlength=256)
    kinds = np.bincount(_CLASS, weights=seen, minlength=5)
    size = max(len(data), 1)
    words = text.split()
    n = max(len(words), 1)
    lines = [line.strip() for line in text.split("\n") if line.strip()]
    m = max(len(lines), 1)
    counts = Counter(words)
    return [
        float(len(words)), sum(map(len, words)) / n, len(counts) / n, sum(map(str.__eq__, words, words[1:])) / n,
        max(counts.values(), default=0) / n, kinds[1] / size, seen[124] / size, kinds[2] / size, kinds[3] / size, kinds[4] / size,
        (seen[46] + seen[33] + seen[63]) / n, float(len(lines)), len(words) / m, 1 - len(set(lines)) / m if lines else 0.0,
        sum(1 for line in lines if line.count(" ") < 3) / m, 1 - len(set(zip(words, words[1:]))) / max(n - 1, 1) if len(words) > 1 else 0.0,  # noqa: B905
        sum(1 for line in lines if line[-1] in ".!?") / m,
    ]


def _with_statistics(rows: DataFrame, name: str) -> DataFrame:
    @F.pandas_udf("array<double>")
    def statistics(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(text_statistics)

    return rows.withColumn(name, statistics(F.coalesce("text", F.lit(""))))


@dataclass(frozen=True)
class QualityModel:
    """Rules with their weights; no rules where the labels hold one class at most, then ``rate`` is every score."""

    rules: list[tuple[Rule, float]]
    intercept: float
    rate: float


def tree_rules(description: str) -> set[Rule]:
    """The way to each node below the root, from a tree's printed form; repeated conditions are merged."""
    found: set[Rule] = set()
    way: list[tuple[int, tuple[int, str, float]]] = []
    for line in description.splitlines():
        step = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-\d.eE]+)\)", line)
        if not step:
            continue
        depth = len(step[1])
        way = [w for w in way if w[0] < depth] + [(depth, (int(step[2]), step[3], float(step[4])))]
        tight: dict[tuple[int, str], float] = {}
        for _, (feature, sign, at) in way:
            key = (feature, sign)
            tight[key] = at if key not in tight else min(tight[key], at) if sign == "<=" else max(tight[key], at)
        found.add(tuple(sorted((f, s, at) for (f, s), at in tight.items())))
    return found


def rule_column(rule: Rule, statistics: Column) -> Column:
    test = F.lit(True)
    for feature, sign, at in rule:
        value = statistics[feature]
        test = test & (value <= at if sign == "<=" else value > at)
    return test


def train_quality(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, fold: int = FOLD) -> QualityModel:
    """Learns from a bounded sample of the labelled rows outside the held-out fold, texts only."""
    sample = labelled_sample(docs, labels, "quality", folds, fold)
    rate = sample.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
    if not 0 < rate < 1:
        return QualityModel([], 0.0, rate)
    rows = written(_with_statistics(sample, "s").select("label", "s"), "statistics").coalesce(2)
    forest = RandomForestClassifier(labelCol="label", featuresCol="v", numTrees=TREES, maxDepth=DEPTH, subsamplingRate=ROWS, seed=1)
    trees = forest.fit(rows.select("label", array_to_vector("s").alias("v"))).trees
    rules = sorted(set().union(*(tree_rules(t.toDebugString) for t in trees)))
    if not rules:
        return QualityModel([], 0.0, rate)
    marks = F.array(*[rule_column(r, F.col("s")).cast("double") for r in rules])
    marked = written(rows.select("label", array_to_vector(marks).alias("features")), "rules").coalesce(2)
    lasso = LogisticRegression(labelCol="label", elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(marked)
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w]
    return QualityModel(weights, float(lasso.intercept), rate)


def quality_column(model: QualityModel, statistics: Column) -> Column:
    """The model as one expression over the array of statistics."""
    if not model.rules:
        return F.lit(float(model.rate))
    terms = F.array(*[F.when(rule_column(r, statistics), w).otherwise(0.0) for r, w in model.rules])
    margin = F.aggregate(terms, F.lit(model.intercept), lambda total, x: total + x)
    return 1 / (1 + F.exp(-margin))


def score_quality(docs: DataFrame, model: QualityModel, name: str) -> DataFrame:
    """``docs`` with ``name``: the score of each whole text, 0 to 1. Missing texts are empty ones."""
    statistics = free_name("quality_statistics", docs)
    return _with_statistics(docs, statistics).withColumn(name, quality_column(model, F.col(statistics))).drop(statistics)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text)."""
    rows = docs.select("doc_id", "text")
    scored = score_quality(rows, train_quality(rows, labels), "score")
    return scored.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
