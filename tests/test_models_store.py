from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rarescan.config import BANK_APPLICATIONS as ROLES
from rarescan.operators import explain, isolation, preprocess
from rarescan.plans import models, training
from rarescan.sources import store as stores
from rarescan.sources import applications as tables_of_applications
from rarescan.sources import tables
from rarescan.sources.applications import applications, applications_view

from quick import QUICK


@pytest.fixture(scope="module")
def train_rows(spark, sf_dir):
    return applications(spark, sf_dir, "train").cache()


@pytest.fixture
def store(spark, tmp_path):
    return stores.Store(spark, str(tmp_path / "store"))


def test_prepared_table_is_the_view(spark, sf_dir):
    view, written = applications_view(spark, sf_dir), applications(spark, sf_dir)
    columns = view.columns
    assert written.select(columns).exceptAll(view).count() == 0
    assert written.count() == view.count()
    assert {r["split"] for r in written.select("split").distinct().collect()} == {"train", "test"}
    assert written.where("fraud_bool IS NULL").count() == 0


def test_one_split_reads_one_folder(spark, sf_dir):
    plan = applications(spark, sf_dir, "test").select("month")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in text
    assert "ReadSchema: struct<month:int>" in text


def test_missing_source_and_label(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        tables.read_table(spark, str(tmp_path / "nowhere"))
    with pytest.raises(ValueError, match="schema"):
        tables.read_table(spark, str(tmp_path), "csv")
    df = spark.createDataFrame([(1, 0)], "a int, is_fraud int")
    assert tables.with_label(df).columns == ["a", "fraud_bool"]
    with pytest.raises(ValueError, match="no label"):
        tables.with_label(df.drop("is_fraud"))
    keyed = tables.with_key(df.union(df), "k")
    assert keyed.select("k").distinct().count() == 1


def test_thresholds(store):
    assert store.load_threshold("xgb") == 0.5
    store.save_threshold("xgb", "20260101", 0.7, "holdout")
    store.save_threshold("xgb", "20260102", 0.8, "holdout")
    store.save_threshold("xgb", "20260103", float("nan"), "holdout")
    assert store.load_threshold("xgb") == 0.8
    assert store.load_threshold("mlp", default=0.4) == 0.4


def test_experiments_and_evaluations(store):
    for run, model in (("1", "xgb"), ("2", "xgb"), ("1", "rf")):
        store.log_experiment(run, run, model, {"depth": 3}, None, None, 0.5, "p", extra={"a": [1]})
    pair = (0.1, 0.2, 0.3)
    store.log_evaluation(("2", "xgb", "t1", 0.8, 0.4, 0.5, pair, pair, {"tp": 1}))
    store.log_evaluation(("2", "xgb", "t2", 0.9, 0.5, 0.5, pair, pair, {"tp": 1}))
    got = {
        r["model"]: r
        for r in stores.latest_evaluation(store.experiments(), store.evaluations()).collect()
    }
    assert (got["xgb"]["run_id"], got["xgb"]["roc_auc"]) == ("2", 0.9)
    assert got["rf"]["roc_auc"] is None  # nothing is attached to the wrong model
    first = store.experiments().where("model = 'rf'").first()
    assert first["best_params"] == {"depth": "3"} and first["best_cv_score"] is None


def test_rerun_replaces_outputs(spark, store):
    df = spark.range(10).withColumn("split", F.lit("train"))
    store.write_splits(df)
    store.write_splits(df.limit(4))
    assert store.read_split("train").count() == 4
    store.write_report("r", df, "csv")
    store.write_report("r", df)
    assert store.read_report("r").count() == 10


def test_search_candidates():
    assert len(models.MODELS["logreg"].candidates()) == 10
    assert len(models.MODELS["dt"].candidates()) == 48
    draws = models.MODELS["xgb"].candidates(seed=1)
    assert len(draws) == 60 and len({str(d) for d in draws}) == 60
    assert draws == models.MODELS["xgb"].candidates(seed=1)
    assert models.MODELS["if"].candidates() == []
    assert "stacking" not in models.choose_models(["all"])
    assert models.choose_models(["rf", "stacking"]) == ["rf", "stacking"]
    with pytest.raises(ValueError, match="unknown"):
        models.choose_models(["nope"])
    assert models.scoring_model(["rf", "xgb"]) == "xgb"
    assert models.scoring_model(["rf", "dt"]) == "rf"


def _auc(score, y):
    ranks = pd.Series(score).rank().to_numpy()
    ones = int(y.sum())
    return (ranks[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize("name", ["xgb", "mlp"])
def test_shared_search_scores_each_candidate_as_if_alone(train_rows, name):
    spec = models.MODELS[name]
    change = {"xgb": {"max_depth": 2, "n_estimators": 3}, "mlp": {"activation": "tanh", "epochs": 2}}[name]
    sets = [QUICK[name], {**QUICK[name], **change}]
    both = training.shared_scores(train_rows, spec, sets, ROLES, training.SETTINGS)
    alone = training.shared_scores(train_rows, spec, sets[1:], ROLES, training.SETTINGS)
    assert both[1] == pytest.approx(alone[0]) and both[0] != pytest.approx(both[1])
    prep = preprocess.preprocessor().fit(train_rows)
    folded = training.sampling.with_folds(train_rows, ROLES.key, spec.folds, f"{training.SETTINGS.seed}-cv")
    ready = prep.transform(folded).select(ROLES.key, ROLES.label, F.col("fold").cast("int"), "features").cache()
    ctx = training.FitContext(ROLES.label, ROLES.key, 0.0, 1, None, training.SETTINGS.seed)
    found = []
    for fold in range(spec.folds):
        (fitted,) = training._shared_members(ready, spec, sets[1:], [fold], ROLES, training.SETTINGS)
        scored = spec.build(sets[1], ctx).model_of(fitted).transform(ready)
        p = scored.select("fold", ROLES.label, training.score_column(name, scored.columns).alias("p")).toPandas()
        found.append([_auc(part["p"], part[ROLES.label].to_numpy()) for part in (p[p.fold == fold], p[p.fold != fold])])
    assert both[1] == pytest.approx(tuple(np.mean(found, axis=0)), abs=1e-9)


@pytest.mark.parametrize("name", list(models.MODELS))
def test_every_model_builds(name):
    spec = models.MODELS[name]
    ctx = training.FitContext("y", "k", 100.0, 4, "weight")
    for params in [spec.defaults, *spec.candidates(limit=3)]:
        assert spec.build(params, ctx).extractParamMap()


def test_train_saves_and_scores(spark, sf_dir, train_rows, store):
    candidates = [{"C": c, "penalty": "l2", "max_iter": 20} for c in (0.001, 1)]
    done = training.train(train_rows, "logreg", "20260101", store, candidates=candidates)
    assert 0.5 < done.cv_score <= 1 and done.params in candidates
    assert store.load_threshold("logreg") == done.threshold
    logged = store.experiments().first()
    assert logged["model"] == "logreg" and logged["search_rows"] == train_rows.count()
    test = applications(spark, sf_dir, "test")
    fresh = training.score(done.model, test, "logreg", [ROLES.key])
    loaded = training.score(store.load_model("logreg"), test, "logreg", [ROLES.key])
    a = {r[0]: r[1] for r in fresh.collect()}
    b = {r[0]: r[1] for r in loaded.collect()}
    assert a == b and all(0 <= v <= 1 for v in a.values())


def test_scoring_keeps_the_raw_columns(spark, sf_dir, train_rows):
    model = training.fit_pipeline(train_rows, models.MODELS["dt"], QUICK["dt"])
    test = applications(spark, sf_dir, "test")
    once = training.score(model, test, "dt")
    assert once.drop("score").exceptAll(test).count() == 0
    twice = training.score(model, once.withColumnRenamed("score", "first"), "dt")
    assert twice.where("score <> first").count() == 0 and twice.count() == test.count()


def test_explanations_add_up(spark, sf_dir, train_rows):
    model = training.fit_pipeline(train_rows, models.MODELS["logreg"], QUICK["logreg"])
    scored = model.transform(applications(spark, sf_dir, "test"))
    names = preprocess.feature_names(scored)
    stage = model.stages[-1]
    terms = explain.linear_terms(stage, names, top=len(names))
    row = scored.select("logreg__raw", terms.alias("t")).first()
    total = sum(t["term"] for t in row["t"]) + stage.intercept
    assert total == pytest.approx(row["logreg__raw"][1], abs=1e-6)
    sizes = [abs(t["term"]) for t in row["t"]]
    assert sizes == sorted(sizes, reverse=True)
    top = explain.importances(spark, stage, names).collect()
    assert len(top) == 20 and explain.importances(spark, stage, names[:-1]) is None


def test_undersampling_touches_the_fit_only(train_rows):
    spec = models.MODELS["mlp"]
    prep = preprocess.preprocessor().fit(train_rows)
    ready = training._prepared(train_rows, prep, ROLES)
    plain, _ = training.balanced_fit_input(ready, spec, ROLES, training.SETTINGS, None)
    assert plain.count() == ready.count() and "weight" in plain.columns  # weighted, not repeated
    under, ctx = training.balanced_fit_input(ready, spec, ROLES, training.SETTINGS, 0.5)
    assert under.count() < ready.count() and ctx.weight_col is None
    tree, ctx = training.balanced_fit_input(ready, models.MODELS["dt"], ROLES, training.SETTINGS, 0.5)
    assert ctx.weight_col == "weight"


def test_stack_rejects_missing_bases(train_rows):
    with pytest.raises(ValueError, match="needs"):
        training.fit_stack(train_rows, {"rf": QUICK["rf"], "logreg": QUICK["logreg"]})


def test_stack_round_trip(spark, sf_dir, train_rows, tmp_path):
    bases = {"xgb": {**QUICK["xgb"], "n_estimators": 2}, "rf": {**QUICK["rf"], "n_estimators": 3}}
    stack, auc = training.fit_stack(train_rows, bases, folds=2)
    assert 0.4 < auc <= 1
    stack.write().save(str(tmp_path / "stack"))
    again = PipelineModel.load(str(tmp_path / "stack"))
    test = applications(spark, sf_dir, "test")
    p = "stacking__probability"
    one = {r[0]: r[1] for r in stack.transform(test).select(ROLES.key, p).collect()}
    two = {r[0]: r[1] for r in again.transform(test).select(ROLES.key, p).collect()}
    assert one == two


def test_tasks_share_the_files_of_the_application_table(spark, sf_dir, monkeypatch):
    """A join leaves few, uneven files; their row groups are small, so that no task has most of the rows."""
    monkeypatch.setattr(tables_of_applications, "ROW_GROUP_BYTES", 16_384)
    path = tables_of_applications.prepared_path(spark, f"{sf_dir}/")
    files = list(Path(path).glob("split=*/*.parquet"))
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert max(m.num_row_groups for m in groups) > 1
    assert max(m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)) < 400
    assert sum(m.num_rows for m in groups) == applications_view(spark, sf_dir).count()


@pytest.mark.parametrize("n", [200, 1000])
def test_tree_samples(spark, n):
    df = spark.range(n).select(
        F.col("id").alias("k"), array_to_vector(F.array(F.col("id").cast("double"))).alias("x")
    )
    got = isolation.tree_samples(df, "k", "x", 7, "s").toPandas()
    sizes = got.groupby("tree").size()
    assert sorted(sizes.index) == list(range(7)) and set(sizes) == {min(n, 256)}
    for _, rows in got.groupby("tree"):
        assert len({tuple(x) for x in rows["x"]}) == len(rows)  # no repeats inside a tree


def test_isolation_forest_finds_outliers(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1000, 3))
    x[:10] += 9
    rows = [(i, v.tolist(), int(i < 10)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k int, a array<double>, y int")
    df = df.withColumn("features", array_to_vector("a")).cache()
    model = isolation.IsolationForest(keyCol="k", trees=50, contamination=0.02).fit(df)
    out = model.transform(df)
    assert training.exact_auc(out, "y") > 0.99
    low, high, flagged = out.agg(F.min("score"), F.max("score"), F.sum("prediction")).first()
    assert (low, high) == (0, 1) and flagged == 20
    model.write().save(str(tmp_path / "forest"))
    again = isolation.IsolationForestModel.load(str(tmp_path / "forest")).transform(df)
    assert again.select("score").collect() == out.select("score").collect()


def test_path_lengths_against_walking_each_row():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(100, 2))
    frames = []
    for tree in range(3):
        nodes = isolation.grow_tree(rows, np.random.default_rng(tree))
        frame = pd.DataFrame(nodes, columns=["node", "slot", "cut", "left", "right", "size"])
        frame.insert(0, "tree", tree)
        frames.append(frame)
        assert frame.loc[frame["slot"] < 0, "size"].sum() == 100
    nodes = pd.concat(frames, ignore_index=True)
    forest = {c: nodes[c].to_numpy() for c in ("slot", "cut", "left", "right")}
    forest["tail"] = np.where(nodes["slot"] < 0, isolation.expected_path(nodes["size"]), 0.0)
    starts = np.flatnonzero(nodes["node"].to_numpy() == 0)
    got = isolation.path_lengths(rows, forest, starts)
    for row, mean in zip(rows[:20], got):
        total = 0.0
        for frame in frames:
            node, depth = frame.iloc[0], 0
            while node["slot"] >= 0:
                left = row[int(node["slot"])] <= node["cut"]
                node = frame.iloc[int(node["left"] if left else node["right"])]
                depth += 1
            total += depth + float(isolation.expected_path(node["size"]))
        assert mean == pytest.approx(total / 3)


def test_walks_go_some_rows_at_a_time(monkeypatch):
    """The same lengths whatever rows are walked together; trees of one node and missing values included."""
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(50, 3))
    trees = [isolation.grow_tree(part, np.random.default_rng(9)) for part in (rows, rows[:1], rows[:9])]
    nodes = np.array([n for tree in trees for n in tree])
    forest = dict(zip(("slot", "cut", "left", "right"), nodes[:, 1:5].T))
    forest = {c: v if c == "cut" else v.astype(int) for c, v in forest.items()}
    forest["tail"] = np.where(forest["slot"] < 0, isolation.expected_path(nodes[:, 5]), 0.0)
    walk = isolation.walkable(forest, np.flatnonzero(nodes[:, 0] == 0))
    rows[3, 0] = np.nan
    want = [isolation.walked_lengths(row[None], walk)[0] for row in rows]
    for size in (1, 7, 50, 4096):
        monkeypatch.setattr(isolation, "ROWS_PER_WALK", size)
        assert isolation.walked_lengths(rows, walk).tolist() == want
    assert isolation.walked_lengths(rows[:0], walk).tolist() == []


def test_expected_path():
    assert isolation.expected_path([1, 2]).tolist() == [0.0, 1.0]
    assert float(isolation.expected_path(256)) == pytest.approx(10.244770920116851)
