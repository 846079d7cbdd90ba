import pytest

from rarescan.config import BANK_APPLICATIONS as ROLES
from rarescan.operators import sampling
from rarescan.plans import jobs, training
from rarescan.sources.applications import applications
from rarescan.sources.store import Store
from rarescan.sources.tables import RAW_COLUMNS, raw_schema

from quick import QUICK


@pytest.fixture(scope="module")
def store(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    source = str(base / "raw")
    raw = applications(spark, sf_dir).select(ROLES.key, *RAW_COLUMNS)
    raw.write.option("header", True).csv(source)
    made = Store(spark, str(base / "store"))
    summary = jobs.prepare(
        spark, source, made, "csv", raw_schema(ROLES.key), exact=True, narrow=True
    )
    counts = {r["split"]: (r["n_rows"], r["n_pos"]) for r in summary.collect()}
    totals = sampling.class_counts(raw, ROLES.label)
    assert counts["test"] == (
        sum(int(n * 0.2 + 0.5) for n in totals.values()),
        int(totals[1] * 0.2 + 0.5),
    )
    return made


def test_splits_share_narrow_types(store):
    train, test = store.read_split("train"), store.read_split("test")
    assert train.schema == test.schema
    kinds = dict(train.dtypes)
    assert kinds["fraud_bool"] == "tinyint" and kinds["zip_count_4w"] == "smallint"
    assert kinds["velocity_6h"] == "double"
    assert train.join(test, ROLES.key).count() == 0


def test_profile_is_written(store):
    names = jobs.write_profile(store.read_split("train"), store)
    assert {"quality", "describe", "outliers", "rank_tests", "mutual_information"} <= set(names)
    for name in names:
        assert store.read_report(name).count() > 0, name
    screened = {r["feature"]: r["action"] for r in store.read_report("screening").collect()}
    assert screened["device_fraud_count"] == "drop"


def test_train_evaluate_decide(spark, store):
    quick = {n: [QUICK[n]] for n in ("xgb", "mlp")}
    done = jobs.train_models(store, ["xgb", "mlp"], "20260101", candidates=quick)
    assert done == ["xgb", "mlp"]
    tables = jobs.evaluate_model(store, "xgb", "20260101", "t1")
    assert tables["importances"].count() == 20
    logged = store.evaluations().first()
    rows = store.read_split("test").count()
    assert sum(logged["confusion"].values()) == rows and logged["at_tuned"]["f1"] >= 0
    decided, cost = jobs.decide(store, store.read_split("test"))
    # the third member was never trained
    assert {r["active_models"] for r in decided.select("active_models").distinct().collect()} == {2}
    assert cost.first()["total"] == rows
    scored = training.score(
        store.load_model("xgb"), store.read_split("train"), "xgb", [ROLES.label]
    )
    threshold = jobs.enforce_precision(store, "xgb", "20260102", scored, ROLES.label, 0.05)
    assert store.load_threshold("xgb") == threshold


def test_stack_of_models_trained_before(spark, store, monkeypatch):
    """Bases from one run, the stack from a later one: trained, saved, loaded, evaluated, logged."""
    monkeypatch.setattr(training, "STACK_FOLDS", 2)
    quick = {"rf": [{**QUICK["rf"], "n_estimators": 4}], "xgb": [{**QUICK["xgb"], "n_estimators": 3}]}
    jobs.train_models(store, ["xgb", "rf"], "20260201", candidates=quick)
    assert store.best_params("rf") == quick["rf"][0] and store.best_params("nobody") is None
    assert jobs.train_models(store, ["stacking"], "20260202") == ["stacking"]
    run = store.experiments().where("model = 'stacking'").first()
    assert run["best_cv_score"] > 0.5 and "rf" in run["best_params"]["bases"]
    tables = jobs.evaluate_model(store, "stacking", "20260202", "t2")
    assert {r["feature"] for r in tables["importances"].collect()} == {"xgb", "rf"}
    logged = store.evaluations().where("model = 'stacking'").first()
    assert sum(logged["confusion"].values()) == store.read_split("test").count()


def test_no_committee(spark, tmp_path, store):
    with pytest.raises(ValueError, match="no committee model"):
        jobs.decide(Store(spark, str(tmp_path)), store.read_split("test"))
