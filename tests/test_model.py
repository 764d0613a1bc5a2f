"""Model pipeline: planted signal, determinism, save/load."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from arrears.operators import features as ft
from arrears.operators import model as ml
from arrears.operators.forest import node_table
from arrears.session import scratch_path

PARAMS = ml.ForestParams(num_trees=15, max_depth=4)


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        score = rnd.randint(300, 850)
        emp = rnd.choice(["Full-time", "Part-time", "Self-employed", "Unemployed", "Retired"])
        y = int(score < 560 or (emp == "Unemployed" and score < 650))
        rows.append((i, Decimal(rnd.randint(1000, 40000)), Decimal("0.1000"), 12 * rnd.randint(1, 5),
                     rnd.randint(1, 20), rnd.randint(0, 5), rnd.random(), float(rnd.randint(0, 60)),
                     rnd.randint(0, 90), rnd.randint(0, 90), Decimal(rnd.randint(20000, 150000)),
                     rnd.randint(21, 69), score, float(rnd.randint(1, 40)), emp, y))
    schema = ("loan_id long, principal decimal(12,2), interest_rate decimal(5,4), term_months int, "
              "total_payments_made long, late_payment_count long, pct_payments_late double, "
              "avg_days_late double, max_days_late_ever int, most_recent_days_late int, "
              "income decimal(12,2), age int, credit_score int, loan_age_months double, "
              "employment_status string, is_default int")
    return ft.stratified_split(spark.createDataFrame(rows, schema))


def test_planted_signal_is_learned(planted):
    run = ml.train_and_evaluate(planted, PARAMS)
    m = run.metrics.first()
    assert m.auc >= 0.9
    probs = [r.probability_of_default for r in run.scored_test.collect()]
    assert all(0.0 <= p <= 1.0 for p in probs)
    imp = ml.feature_importance(run.model).collect()
    assert len(imp) == 10 and imp[0].feature in ("credit_score", "employment_status_Unemployed")


def test_same_seed_same_metrics(planted):
    a = ml.train_and_evaluate(planted, PARAMS).metrics.first()
    b = ml.train_and_evaluate(planted, PARAMS).metrics.first()
    assert a == b


def test_save_and_load_keep_predictions(spark, planted):
    run = ml.train_and_evaluate(planted, PARAMS)
    path = scratch_path(spark, "t-model")
    ml.save(run.model, path)
    again = ml.score(ml.load(path), planted.where(F.col("split") == "test"))
    assert ml.saved_feature_columns(path) == ml.DESIGN_COLUMNS
    before = {r.loan_id: r.probability_of_default for r in run.scored_test.collect()}
    after = {r.loan_id: r.probability_of_default for r in again.collect()}
    assert before == after


def test_run_metrics_rows(planted):
    run = ml.train_and_evaluate(planted, PARAMS)
    rows = ml.run_metrics(run).collect()
    kinds = {(r.kind, r.name) for r in rows}
    assert ("metric", "auc") in kinds and ("param", "n_estimators") in kinds
    assert len({r.run_id for r in rows}) == 1


def test_model_scores_feed_recommendations(planted):
    from arrears.operators import recommend as rc
    from arrears.sources.schemas import ACTION_TYPES
    run = ml.train_and_evaluate(planted, PARAMS)
    assert run.scored_test.schema["principal"].dataType.simpleString() == "decimal(12,2)"
    recs = rc.best_actions(run.scored_test).collect()
    assert len(recs) == run.scored_test.count() > 0
    assert {r.recommended_action for r in recs} <= set(ACTION_TYPES)
    assert all(r.risk_tier in ("Low", "Medium", "High") for r in recs)


def test_scores_in_a_session_that_observed_a_table(spark, planted):
    seen = Observation("t-model")
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 10}
    run = ml.train_and_evaluate(planted, ml.ForestParams(num_trees=3, max_depth=2))
    assert run.scored_test.count() == planted.where("split = 'test'").count()
    assert not run.model.stages[-1].hasSummary


def test_training_rows_are_spread_over_bounded_partitions(planted, monkeypatch):
    train = planted.where("split = 'train'").coalesce(1)
    assert ml.spread(train).rdd.getNumPartitions() == 1                 # few rows stay as they are
    monkeypatch.setattr(ml, "PARTITION_ROWS", 40)
    parts = [sorted(p) for p in ml.spread(train).rdd.glom().collect()]
    assert max(len(p) for p in parts) <= 2 * 40 < train.count() / 4
    assert sorted(r for p in parts for r in p) == sorted(train.collect())
    other_way = ml.spread(train.orderBy(F.desc("loan_id"))).rdd.glom().collect()
    assert other_way == ml.spread(train).rdd.glom().collect()
    few = ml.ForestParams(num_trees=3, max_depth=2)
    assert ml.fit(ml.with_class_weight(train, ml.class_weights(planted)), few).stages[-1].totalNumNodes > 3


def test_a_large_training_set_is_fitted_in_groups_of_trees(spark, planted, monkeypatch):
    train = ml.with_class_weight(planted.where("split = 'train'"), ml.class_weights(planted))
    params = ml.ForestParams(num_trees=10, max_depth=4)
    at_once = ml.fit(train, params).stages[-1]
    monkeypatch.setattr(ml, "PARTITION_ROWS", 300)
    monkeypatch.setattr(ml, "GROUP_TREES", 4)
    grown, pipeline = [], ml.forest_pipeline

    def spied(group, *args):
        grown.append(pipeline(group, *args).getStages()[-1])
        return pipeline(group, *args)
    monkeypatch.setattr(ml, "forest_pipeline", spied)
    model = ml.fit(train, params)
    forest = model.stages[-1]
    assert [f.getNumTrees() for f in grown] == [4, 4, 2] and not any(f.getCacheNodeIds() for f in grown)
    assert len({f.getSeed() for f in grown}) == 3 and grown[0].getSeed() == params.seed
    assert forest.getNumTrees == 10 and not forest.hasSummary
    nodes = node_table(model).groupBy("tree").agg(F.sort_array(F.collect_list("n_rows")).alias("n")).collect()
    assert len({tuple(r.n) for r in nodes}) == 10                                   # no tree comes twice
    for p in ("maxDepth", "minInstancesPerNode", "featureSubsetStrategy", "seed", "numTrees", "cacheNodeIds", "featuresCol",
              "labelCol", "weightCol", "probabilityCol", "predictionCol", "impurity", "maxBins", "subsamplingRate", "bootstrap"):
        if at_once.hasParam(p):
            assert forest.getOrDefault(p) == at_once.getOrDefault(p), p

    def scores(m):
        return {r.loan_id: (r.probability_of_default, r.prediction) for r in ml.score(m, planted).collect()}
    path = scratch_path(spark, "t-groups")
    ml.save(model, path)
    assert scores(model) == scores(ml.load(path)) == scores(ml.fit(train, params))
    assert ml.evaluate(ml.score(model, planted.where("split = 'test'"))).first().auc >= 0.9
    assert abs(sum(forest.featureImportances.toArray()) - 1) < 1e-9


def test_the_walk_of_a_forest_grown_in_groups(planted, monkeypatch):
    from arrears.operators import forest
    monkeypatch.setattr(ml, "PARTITION_ROWS", 300)
    monkeypatch.setattr(ml, "GROUP_TREES", 3)
    run = ml.train_and_evaluate(planted, ml.ForestParams(num_trees=7, max_depth=3))
    nodes = forest.node_table(run.model)
    assert {r.tree for r in nodes.select("tree").distinct().collect()} == set(range(7))
    walked = forest.probabilities(nodes, ml.one_hot_stage().transform(planted), ft.DESIGN_COLUMNS, 3)
    own = ml.score(run.model, planted).select("loan_id", F.col("probability_of_default").alias("p"))
    assert own.join(walked, "loan_id").where("p = probability_of_default").count() == planted.count()
    assert all(r.n_broken == 0 for r in forest.audit(nodes, 3, 10).collect())


def _scratch_tables(spark):
    import os
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {n.split("arrears-", 1)[1].rsplit("-", 1)[0] for n in os.listdir(folder) if "arrears-" in n}, folder


def test_training_leaves_only_the_scores_in_scratch(spark, planted, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        split = ft.stratified_split(planted.drop("split"))
        assert _scratch_tables(spark)[0] == {"split-cuts"}
        run = ml.train_and_evaluate(split, ml.ForestParams(num_trees=3, max_depth=2))
        assert _scratch_tables(spark)[0] == {"split-cuts", "scored", "auc-scores"}
        assert run.scored_test.count() == split.where("split = 'test'").count() and run.metrics.first().auc > 0
    finally:
        spark.sparkContext.setCheckpointDir(before)


def test_the_books_inputs_are_read_once_for_the_walk(spark, planted, monkeypatch):
    from arrears.plans import catalog
    from arrears.plans.inspect import physical_plan
    few = ml.ForestParams(num_trees=3, max_depth=2)
    monkeypatch.setattr(catalog, "_training_run", lambda spark, sf_dir: ml.train_and_evaluate(planted, few))
    monkeypatch.setattr(catalog, "_features", lambda spark, sf_dir: planted.withColumn("loan_id", F.col("loan_id") + F.uuid().isNull().cast("int")))
    checked = catalog.q_rf_node_walk(spark, "")
    assert "uuid" not in physical_plan(checked)                # what makes the inputs does not run again
    assert tuple(checked.first()) == (600, 600, 600)
