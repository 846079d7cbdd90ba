import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rarescan.config import BANK_APPLICATIONS as ROLES
from rarescan.operators import features, preprocess
from rarescan.operators.features import FeatureStep
from rarescan.sources.tables import column_roles, raw_schema


@pytest.fixture(scope="module")
def three(spark):
    """Three applications with known results."""
    base = {f.name: 0.0 if f.dataType.simpleString() == "double" else 1 for f in raw_schema()}
    rows = []
    for i, change in enumerate(
        (
            dict(prev_address_months_count=-1, bank_months_count=-1, housing_status="BA",
                 employment_status="CA", device_os="windows", email_is_free=0,
                 device_distinct_emails_8w=1, phone_home_valid=0, phone_mobile_valid=1,
                 velocity_6h=1000.0, velocity_4w=3000.0, current_address_months_count=5,
                 customer_age=20, payment_type="AA", source="INTERNET"),
            dict(prev_address_months_count=20, bank_months_count=10, housing_status="BB",
                 employment_status="CC", device_os="linux", email_is_free=1,
                 device_distinct_emails_8w=1, phone_home_valid=1, phone_mobile_valid=1,
                 velocity_6h=5000.0, velocity_4w=5000.0, current_address_months_count=50,
                 customer_age=40, payment_type="AC", source="TELEAPP"),
            dict(prev_address_months_count=100, bank_months_count=30, housing_status="BC",
                 employment_status="CG", device_os="macintosh", email_is_free=0,
                 device_distinct_emails_8w=2, phone_home_valid=0, phone_mobile_valid=1,
                 velocity_6h=10000.0, velocity_4w=-1.0, current_address_months_count=200,
                 customer_age=60, payment_type=None, source="INTERNET"),
        )
    ):
        row = {**base, **change, "application_id": i}
        rows.append(row)
    schema = raw_schema("application_id")
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)


def column(df, name):
    return [r[0] for r in df.orderBy("application_id").select(name).collect()]


def test_feature_step_values(three):
    out = FeatureStep().fit(three).transform(three)
    assert "device_fraud_count" not in out.columns
    assert "session_length_in_minutes" not in out.columns
    assert column(out, "has_prev_address") == [0, 1, 1]
    assert column(out, "prev_address_months_count") == [None, pytest.approx(20.8), pytest.approx(99.2)]
    assert column(out, "has_bank_history") == [0, 1, 1]
    assert column(out, "bank_months_count") == [None, 10, 30]
    assert column(out, "is_high_risk_housing") == [1, 0, 0]
    assert column(out, "is_high_risk_employment") == [0, 1, 0]
    assert column(out, "is_high_risk_os") == [1, 0, 0]
    assert column(out, "is_high_risk_payment") == [0, 1, 0]  # null is no risk
    assert column(out, "is_teleapp_source") == [0, 1, 0]
    assert column(out, "digital_risk_score") == [0, 1, 0]
    assert column(out, "phone_mismatch") == [1, 0, 1]
    # the last one has a denominator of 0
    assert column(out, "velocity_anomaly") == [
        pytest.approx(1000 / 3001), pytest.approx(5000 / 5001), None,
    ]
    assert column(out, "address_stability") == [
        pytest.approx(5 / 241), pytest.approx(50 / 481), pytest.approx(200 / 721),
    ]


def test_nulls_and_missing_columns(spark):
    df = spark.createDataFrame(
        [(None, None, 1), (-1, 5, None)],
        "bank_months_count long, phone_home_valid long, phone_mobile_valid long",
    )
    out = features.engineer(df, ROLES, {}).collect()
    assert [r["has_bank_history"] for r in out] == [1, 0]  # unknown is not the marker
    assert [r["phone_mismatch"] for r in out] == [1, 1]
    assert "velocity_anomaly" not in out[0].asDict()


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (1.0,), (9.0,)], "proposed_credit_limit double")
    out = features.engineer(df, ROLES, {"proposed_credit_limit": [2.0, 5.0]})
    assert [r[0] for r in out.collect()] == [None, 2.0, 5.0]


def test_engineered_names_match_columns(three):
    out = FeatureStep().fit(three).transform(three)
    numeric, categorical = features.engineered_names(ROLES, three.columns)
    assert set(numeric) | set(categorical) == set(out.columns) - {"application_id", "fraud_bool"}
    assert len(numeric) + len(categorical) > len(ROLES.features)
    found = column_roles(out, "fraud_bool", "application_id")
    assert (set(found[0]), set(found[1])) == (set(numeric), set(categorical))


def test_numeric_fit_uses_filled_quartiles(spark):
    values = [1.0, 2.0, 3.0, 4.0, None, None, None, None]
    df = spark.createDataFrame([(v, 7.0) for v in values], "a double, same double")
    fitted = preprocess.fit_numeric(df, ["a", "same"])
    filled = np.array([1, 2, 3, 4, 2.5, 2.5, 2.5, 2.5])
    assert fitted["a"]["fill"] == 2.5
    assert fitted["a"]["spread"] == np.percentile(filled, 75) - np.percentile(filled, 25)
    assert fitted["same"] == {"fill": 7.0, "centre": 7.0, "spread": 1.0}


def test_unseen_category_codes_as_zeros_and_names_fit(spark, three, tmp_path):
    model = preprocess.preprocessor().fit(three)
    new = three.withColumn("device_os", F.lit("beos"))
    out = model.transform(new)
    names = preprocess.feature_names(out)
    rows = out.select(vector_to_array("features").alias("x")).collect()
    assert all(len(r["x"]) == len(names) for r in rows)
    slots = [i for i, n in enumerate(names) if n.startswith("device_os=")]
    assert [names[i] for i in slots] == ["device_os=linux", "device_os=macintosh", "device_os=windows"]
    assert all(r["x"][i] == 0 for r in rows for i in slots)
    assert "payment_type=missing" in names and names[0] == "income"
    # the saved preprocessing scores raw rows
    model.write().save(str(tmp_path / "prep"))
    again = PipelineModel.load(str(tmp_path / "prep")).transform(new)
    assert again.select("features").collect() == out.select("features").collect()
    assert preprocess.feature_names(again) == names
