"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

The lexicon is learned from the labelled sample: words and word beginnings that are far more frequent
in documents labelled toxic. Features are densities of its words, how near they stand to a second
person pronoun, and rates of capitals, punctuation and obfuscated spelling.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import free_name, written
from riskstream.llm.labelled import held_out, labelled_sample

FOLDS, FOLD, CUT = 4, 2, 0.3
#: Lexicon: documents that must hold a unit, how many times likelier it must be in toxic ones, and units at most.
LEAST_DOCS, LIFT, UNITS = 3, 8.0, 600
#: Letters of the word beginnings in the lexicon, and words of the window for the densest place.
STEMS, WINDOW = (4, 5), 50
#: Boosting: trees, depth, step.
TREES, DEPTH, STEP = 24, 4, 0.2
#: Of the sample, one row in so many calibrates and is not seen by the trees.
CALIBRATE = 4
#: Share of the uncalibrated probability in a score, which keeps the order within calibrated steps.
ORDER = 0.01

#: Second person pronouns, and characters that stand for letters.
SECOND_PERSON = frozenset("you your yours yourself u du dich dir dein deine ihr euch tu te toi ton vous votre tú ti usted ustedes vosotros".split())
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")
LETTERS = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"(?<!\S)\S*[^\W\d_][0-9@$!|*._\-]+[^\W\d_]\S*")
CAPITALS = re.compile(r"\b[^\W\d_a-zà-ÿ]{2,}\b")
PUNCTUATION = re.compile(r"[^\w\s]")


@dataclass(frozen=True)
class ToxicityModel:
    """None for ``trees`` where the labels hold one class at most: then ``rate`` is every score."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float


def _units(text_column: str):
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_column)), F.lit("(\\p{L}+)"), F.lit(1)))
    stems = [F.transform(F.filter(words, lambda w, n=n: F.length(w) > n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*")))
             for n in STEMS]
    return F.array_distinct(F.concat(words, *stems))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Unit -> log of its lift, the ``UNITS`` largest at most; ``abcd*`` is a word beginning."""
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = counts.get(1.0, 0), counts.get(0.0, 0)
    seen = (sample.select("label", F.explode(_units("text")).alias("unit")).groupBy("unit")
            .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")))
    lift = (F.col("t") / (toxic + 1)) / ((F.col("c") + 0.5) / (clean + 1))
    top = (seen.where(F.col("t") >= LEAST_DOCS).withColumn("lift", lift).where(F.col("lift") >= LIFT)
           .orderBy(F.desc(F.col("t") * F.log("lift")), "unit").limit(UNITS))
    return {r["unit"]: math.log(r["lift"]) for r in top.collect()}


def toxicity_features(text: str, lexicon: dict[str, float]) -> list[float]:
    words = LETTERS.findall(text.lower())
    n = len(words)
    long, short = max(STEMS), min(STEMS)
    hits, weights, stems, second = [], [], 0, []
    for at, word in enumerate(words):
        weight = lexicon.get(word)
        if weight is None and len(word) > short:
            weight = lexicon.get(word[:short] + "*") or (lexicon.get(word[:long] + "*") if len(word) > long else None)
            stems += weight is not None
        if weight is not None:
            hits.append(at)
            weights.append(weight)
        if word in SECOND_PERSON:
            second.append(at)
    densest = first = 0
    for last, at in enumerate(hits):
        while hits[first] <= at - WINDOW:
            first += 1
        densest = max(densest, last - first + 1)
    nearest, place = n + 1, 0
    for at in hits:
        while place + 1 < len(second) and abs(second[place + 1] - at) <= abs(second[place] - at):
            place += 1
        if second:
            nearest = min(nearest, abs(second[place] - at))
    masked = MASKED.findall(text)
    unmasked = [re.sub(r"[^\w]|[\d_]", "", m.lower().translate(LOOKALIKES)) for m in masked]
    found = sum(1 for u in unmasked if u in lexicon or u[:long] + "*" in lexicon or u[:short] + "*" in lexicon)
    size = max(len(text), 1)
    return [
        math.log1p(n), len(hits) / max(n, 1), math.log1p(len(hits)), float(densest), float(len({words[h] for h in hits})),
        sum(weights) / math.sqrt(n + 1), max(weights, default=0.0), stems / max(n, 1), math.log1p(stems),
        1 / (1 + nearest), len(second) / max(n, 1), sum(map(str.isupper, text)) / size, len(CAPITALS.findall(text)) / max(n, 1),
        text.count("!") / size, len(PUNCTUATION.findall(text)) / size, len(masked) / max(n, 1), math.log1p(found),
    ]


def _with_features(rows: DataFrame, lexicon: dict[str, float], name: str) -> DataFrame:
    @F.pandas_udf("array<double>")
    def features(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda t: toxicity_features(t, lexicon))

    return rows.withColumn(name, features(F.coalesce("text", F.lit(""))))


def train_toxicity(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, fold: int = FOLD) -> ToxicityModel:
    """Learns from a bounded sample of the labelled rows outside the held-out fold, texts only."""
    sample = labelled_sample(docs, labels, "toxic", folds, fold)
    rate = sample.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
    if not 0 < rate < 1:
        return ToxicityModel({}, None, None, rate)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(CALIBRATE)).alias("part")
    lexicon = learn_lexicon(sample.where(part != 0))  # rows that calibrate are new to the lexicon too
    rows = _with_features(sample, lexicon, "f").select("doc_id", "label", part, array_to_vector("f").alias("features"))
    rows = written(rows, "features")
    grow, check = rows.where("part <> 0"), rows.where("part = 0")
    if grow.select("label").distinct().count() < 2:
        return ToxicityModel({}, None, None, rate)
    trees = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=1).fit(grow.coalesce(2))
    margins = trees.transform(check).select("label", vector_to_array("probability")[1].alias("p"))
    calibration = None if check.isEmpty() else IsotonicRegression(labelCol="label", featuresCol="p").fit(margins.coalesce(1))
    return ToxicityModel(lexicon, trees, calibration, rate)


def score_toxicity(docs: DataFrame, model: ToxicityModel, name: str) -> DataFrame:
    """``docs`` with ``name``: the score of each whole text, 0 to 1. Missing texts are empty ones."""
    if model.trees is None:
        return docs.withColumn(name, F.lit(float(model.rate)))
    kept = docs.columns
    features, p, calibrated = (free_name(f"toxicity_{c}", docs) for c in ("features", "p", "calibrated"))
    rows = _with_features(docs, model.lexicon, features).withColumn(features, array_to_vector(features))
    trees = model.trees.copy().setFeaturesCol(features)
    for setter in (trees.setPredictionCol, trees.setProbabilityCol, trees.setRawPredictionCol):
        setter(free_name(f"toxicity_{setter.__name__}", docs))
    rows = trees.transform(rows)
    rows = rows.withColumn(p, vector_to_array(trees.getProbabilityCol())[1])
    if model.calibration is None:
        rows = rows.withColumn(calibrated, F.col(p))
    else:
        rows = model.calibration.copy().setFeaturesCol(p).setPredictionCol(calibrated).transform(rows)
    score = (1 - ORDER) * F.col(calibrated) + ORDER * F.col(p)
    return rows.withColumn(name, F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))).select(*kept, name)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text). Repeated rows stay and score alike,
    missing texts are empty ones, an empty table gives no rows, further columns are not looked at."""
    rows = docs.select("doc_id", "text")
    scored = score_toxicity(rows, train_toxicity(rows, labels), "score")
    return scored.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is below ``CUT``."""
    name = free_name("toxicity_score", docs)
    scored = score_toxicity(docs, train_toxicity(docs.select("doc_id", "text"), labels), name)
    return scored.where(F.col(name) < CUT).drop(name)
