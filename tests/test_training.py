from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from riskstream.operators.features import with_extended_features
from riskstream.operators.lookup import category_risk, with_category_risk
from riskstream.operators.sampling import train_test
from riskstream.plans import registry
from riskstream.plans import training as tr
from riskstream.plans.transactions import transactions
from riskstream.schema import FOREST_FEATURES
from riskstream.streaming.runner import load_model

FEW = {
    "decision_tree": lambda: DecisionTreeClassifier(maxDepth=6, maxBins=64, seed=42),
    "random_forest": lambda: RandomForestClassifier(numTrees=10, maxDepth=6, seed=41),
    "random_forest_small": lambda: RandomForestClassifier(numTrees=8, maxDepth=6, maxBins=100, seed=42),
    "random_forest_lean": lambda: RandomForestClassifier(numTrees=8, maxDepth=6, seed=42),
    "boosted_trees": lambda: GBTClassifier(maxIter=4, maxDepth=4, seed=42),
}


@pytest.fixture(scope="module")
def rows(spark):
    table = with_extended_features(transactions(spark, "/root/testdata/sf0.01"), F.lit("2024-06-30").cast("date"))
    train, _ = train_test(table)
    return with_category_risk(table, category_risk(train)).persist()


@pytest.fixture(scope="module")
def fitted(rows):
    train, _ = train_test(rows)
    recipes = {name: replace(recipe, estimator=FEW[name]) for name, recipe in tr.RECIPES.items()}
    return {name: (r, tr.fit(r, train)) for name, r in recipes.items()}


@pytest.mark.parametrize("name", sorted(FEW))
def test_models_beat_a_floor_and_report_whole_counts(rows, fitted, name):
    recipe, model = fitted[name]
    _, test = train_test(rows)
    row = tr.evaluate(model, recipe, test).first()
    assert row.model == name and row.auc > 0.85
    assert row.tp + row.fp + row.fn + row.tn == test.count()


@pytest.mark.parametrize("name", sorted(FEW))
def test_saved_model_scores_the_same(rows, fitted, name, tmp_path):
    recipe, model = fitted[name]
    tr.save_model(model, str(tmp_path / "m"))
    tr.save_model(model, str(tmp_path / "m"))  # saving replaces
    loaded = load_model(str(tmp_path / "m"))
    a = tr.score(model, recipe, rows).select("transaction_id", "prediction", "fraud_probability")
    b = tr.score(loaded, recipe, rows).select("transaction_id", "prediction", "fraud_probability")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("name", sorted(FEW))
def test_scoring_needs_no_label_and_keeps_incomplete_rows(rows, fitted, name):
    recipe, model = fitted[name]
    bare = rows.withColumns({"is_fraud": F.lit(None).cast("int"), "dob": F.lit(None).cast("string"),
                             "age": F.lit(None).cast("bigint"), "city_pop": F.lit(None).cast("int")})
    scored = tr.score(model, recipe, bare)
    assert scored.count() == rows.count()
    assert scored.filter("fraud_probability is null or prediction is null").isEmpty()
    assert set(scored.columns) == set(rows.columns) | {"prediction", "fraud_probability"}


def test_unseen_category_is_scored(rows, fitted):
    recipe, model = fitted["decision_tree"]
    odd = rows.filter("dob is not null").withColumn("category", F.lit("never seen"))
    assert tr.score(model, recipe, odd).count() == odd.count()


def test_threshold_overrides_the_models_own_cut(rows, fitted):
    recipe, model = fitted["random_forest"]
    scored = tr.score(model, recipe, rows, threshold=0.2)
    assert scored.filter("(fraud_probability >= 0.2) <> (prediction = 1)").isEmpty()
    assert scored.filter("prediction = 1").count() >= tr.score(model, recipe, rows).filter("prediction = 1").count()


def test_balancing_raises_recall(rows):
    train, test = train_test(rows)
    recipe = replace(tr.DECISION_TREE, estimator=FEW["decision_tree"])
    plain = tr.evaluate(tr.fit(recipe, train), recipe, test).first()
    balanced = tr.evaluate(tr.fit(recipe, train, balance=True), recipe, test).first()
    assert balanced.recall > plain.recall


def test_rows_without_label_are_not_trained_on(rows, fitted):
    recipe, model = fitted["decision_tree"]
    train, _ = train_test(rows)
    noisy = train.unionByName(train.withColumn("is_fraud", F.lit(None).cast("int")))
    again = tr.fit(recipe, noisy)
    assert again.stages[-1].toDebugString.splitlines()[1:] == model.stages[-1].toDebugString.splitlines()[1:]


def test_importance_lists_every_input_largest_first(fitted):
    recipe, model = fitted["random_forest"]
    table = tr.feature_importance(model, recipe).collect()
    assert {r.feature for r in table} == set(FOREST_FEATURES) and len(FOREST_FEATURES) == 21
    weights = [r.importance for r in table]
    assert weights == sorted(weights, reverse=True) and sum(weights) == pytest.approx(1.0)


def test_comparison_is_ordered_by_area(rows, fitted):
    _, test = train_test(rows)
    table = tr.compare([tr.evaluate(m, r, test) for r, m in fitted.values()]).collect()
    areas = [r.auc for r in table]
    assert len(table) == len(FEW) and areas == sorted(areas, reverse=True)


def test_error_mode_refuses_incomplete_rows(rows):
    recipe = replace(tr.DECISION_TREE, estimator=FEW["decision_tree"], incomplete="error")
    model = tr.fit(recipe, rows.filter("dob is not null"))
    assert tr.score(model, recipe, rows.filter("dob is not null")).count() > 0
    with pytest.raises(Exception, match="null"):
        tr.score(model, recipe, rows.filter("dob is null")).collect()


def test_one_model_whatever_the_pieces(spark, rows):
    """Sampling goes by piece and place; the same rows in other pieces and orders give the same forest."""
    forests = [tr.fit(tr.RANDOM_FOREST_SMALL, part).stages[-1].toDebugString.partition("\n")[2]
               for part in (rows.coalesce(1), rows.repartition(5, "merchant").sortWithinPartitions("amount"))]
    assert forests[0] == forests[1]


def test_only_the_scoring_itself_carries_the_model(rows, fitted, monkeypatch):
    recipe, model = fitted["random_forest"]
    seen, area = [], tr.area_under_roc

    def look(judged, *names):
        seen.append(judged._jdf.queryExecution().toString())
        return area(judged, *names)

    monkeypatch.setattr(tr, "area_under_roc", look)
    assert tr.evaluate(model, recipe, rows.limit(500)).first().auc is not None
    assert len(seen) == 1 and "UDF" not in seen[0] and "Scan" in seen[0]


def test_the_deep_forest_remembers_nodes_and_grows_the_same_trees(rows):
    assert tr.RANDOM_FOREST.estimator().getCacheNodeIds()
    train, _ = train_test(rows)
    grown = [tr.fit(replace(tr.RANDOM_FOREST, estimator=lambda kept=kept: tr.RANDOM_FOREST.estimator().setNumTrees(3).setCacheNodeIds(kept)), train)
             for kept in (True, False)]
    with_nodes, without = (m.stages[-1].toDebugString.split("\n", 1)[1] for m in grown)
    assert with_nodes == without


def test_the_trainer_reads_kept_vectors_and_nothing_stays(spark, rows):
    seen = []

    class Looking(DecisionTreeClassifier):
        def fit(self, dataset, params=None):
            seen.append((dataset.columns, dataset._jdf.queryExecution().toString()))
            return super().fit(dataset, params)

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    tr.fit(replace(tr.DECISION_TREE, estimator=lambda: Looking(maxDepth=3, maxBins=64, seed=42)), rows)
    (columns, plan), = seen
    assert "InMemoryTableScan" in plan and "features" in columns and "in_amount" not in columns
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


@pytest.mark.parametrize("name", ["model_facts", "model_comparison"])
def test_models_are_compared_on_rows_made_once(spark, monkeypatch, name):
    made, make = [], registry._model_rows
    monkeypatch.setattr(registry, "_model_rows", lambda *a: made.append(a) or make(*a))
    for constant, recipe in (("DECISION_TREE", "decision_tree"), ("RANDOM_FOREST_SMALL", "random_forest_small"), ("BOOSTED_TREES", "boosted_trees")):
        monkeypatch.setattr(tr, constant, replace(tr.RECIPES[recipe], estimator=FEW[recipe]))
    shared = registry.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert len(made) == 1
    if name == "model_comparison":
        alone = [registry._evaluated(spark, "/root/testdata/sf0.001", r, registry._train(spark, "/root/testdata/sf0.001", r)).first()
                 for r in (tr.DECISION_TREE, tr.RANDOM_FOREST_SMALL, tr.BOOSTED_TREES)]
        assert sorted(shared) == sorted(alone)
