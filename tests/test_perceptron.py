"""Perceptrons: gradients by finite differences, weights as copies, early stopping, shared passes."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rarescan.operators import perceptron
from rarescan.operators.perceptron import Perceptron, PerceptronClassifier, PerceptronModel


def _sample(n=60, seed=3):
    random = np.random.default_rng(seed)
    x = random.normal(size=(n, 4))
    y = (x[:, 0] * x[:, 1] + 0.3 * random.normal(size=n) > 0).astype(float)
    return x, y, random.uniform(0.2, 3, n)


@pytest.mark.parametrize("activation", ["relu", "tanh"])
@pytest.mark.parametrize("hidden", [(), (5,), (4, 3)])
def test_gradients_by_finite_differences(activation, hidden):
    x, y, w = _sample()
    how = Perceptron(hidden=hidden, activation=activation)
    flat, sizes = how.start(4), how.sizes(4)
    _, found = perceptron.sums(flat, sizes, activation, x, y, w)
    for at in range(len(flat)):
        step = np.zeros_like(flat)
        step[at] = 1e-6
        up, down = (perceptron.sums(flat + s, sizes, activation, x, y, w)[0] for s in (step, -step))
        assert found[at] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-4)


@pytest.fixture(scope="module")
def rows(spark):
    x, y, _ = _sample(1500)
    data = [(i, float(t), int(i % 3), [float(v) for v in r]) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "k long, y double, fold int, v array<double>")
    return df.select("k", "y", "fold", array_to_vector("v").alias("features"), (1 + F.col("y") * 2).alias("w"))


def test_weights_are_copies(rows):
    how = Perceptron(hidden=(6,))
    nets = [(how, how.start(4))]
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("w").cast("int")))).drop("copy")
    ((loss, slope),) = perceptron.gradients(rows, nets, "y", "k", weight=F.col("w"))
    ((loss_c, slope_c),) = perceptron.gradients(copies, nets, "y", "k")
    assert loss == pytest.approx(loss_c) and np.allclose(slope, slope_c)


def test_learns_stops_early_and_shares_passes(rows):
    base = Perceptron(hidden=(16,), learning_rate=0.02, epochs=60, patience=4, batch=128)
    hows = [base, Perceptron(hidden=(16,), learning_rate=0.02, epochs=60, patience=4, batch=128, without_fold=1),
            Perceptron(hidden=(3,), activation="tanh", alpha=500.0, learning_rate=0.02, epochs=5, batch=128)]
    all_three = perceptron.fit(rows, hows, "y", "k", fold="fold")
    alone = perceptron.fit(rows, [base], "y", "k")[0]
    assert np.allclose(all_three[0].flat, alone.flat)  # what else is fitted changes nothing
    left_out = perceptron.fit(rows.where("fold <> 1"), [hows[1]], "y", "k")[0]
    assert len(left_out.losses) > 1 and not np.allclose(all_three[1].flat, alone.flat)
    losses = [held for _, held in alone.losses]
    assert len(losses) < 60 and min(losses) < 0.75 * losses[0]
    best = int(np.argmin(losses))
    assert best >= len(losses) - 1 - 2 * base.patience and len(losses) - 1 > best  # patience ran out after it
    heavy, light = (np.square(t.flat).sum() for t in (all_three[2], alone))
    assert heavy < light and len(all_three[2].losses) == 5


def test_pipeline_stage_saves_and_scores(rows, tmp_path):
    settings = '{"hidden": [8], "epochs": 3, "learning_rate": 0.05}'
    model = PerceptronClassifier(labelCol="y", keyCol="k", weightCol="w", settings=settings).fit(rows)
    model.write().overwrite().save(str(tmp_path / "net"))
    again = PerceptronModel.load(str(tmp_path / "net"))
    one, two = ([r.prediction for r in m.transform(rows).orderBy("k").select("prediction").collect()] for m in (model, again))
    assert one == two and set(one) <= {0.0, 1.0}


def test_odd_tables(rows):
    how = Perceptron(hidden=(2,), epochs=2)
    empty = perceptron.fit(rows.limit(0), [how], "y", "k")[0]
    assert empty.features == 0 and np.isfinite(empty.flat).all()
    nulls = rows.select("k", F.lit(None).cast("double").alias("y"), F.lit(None).cast("double").alias("w"), "features")
    assert np.isfinite(perceptron.fit(nulls, [how], "y", "k", weight=F.col("w"))[0].flat).all()
    with pytest.raises(ValueError):
        Perceptron(activation="step")


def test_written_blocks_and_row_groups_are_small(spark):
    import pyarrow.parquet as pq

    from rarescan.operators.perceptron import BLOCK_BYTES, Rows
    from rarescan.sources.shared import ROW_GROUP_BYTES

    x = array_to_vector(F.transform(F.sequence(F.lit(1), F.lit(100)), lambda i: F.rand(7) + i))
    df = spark.range(40_000, numPartitions=1).select("id", (F.col("id") % 2).alias("y"), x.alias("features"))
    rows = Rows(df, "y", "id", "features", None, None, 1 << 62, validation=False)
    assert rows.blocks.agg(F.sum("n"), F.max(F.length("x")) <= BLOCK_BYTES).first()[:] == (40_000, True)
    groups = [
        pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(g).total_byte_size
        for f in rows.blocks.inputFiles()
        for g in range(pq.ParquetFile(f.removeprefix("file://")).num_row_groups)
    ]
    assert sum(groups) > 30_000_000 and max(groups) < 2 * ROW_GROUP_BYTES
    rows.close()


def test_packed_rows_are_the_same_rows():
    x = np.random.default_rng(2).normal(size=(50, 6))
    x[:, 1], x[:, 3], x[:, 4] = np.arange(50) % 3, -7.0, 300.0
    found = perceptron.packed(x)
    assert len(found) == 6 + 50 * (2 + 4 * 8) and (perceptron.unpacked(found, 50, 6) == x).all()
    wider = perceptron.unpacked(found, 50, 6, 1)
    assert (wider[:, :6] == x).all() and (wider[:, 6] == 1).all()
    assert perceptron.unpacked(perceptron.packed(x[:0]), 0, 6).shape == (0, 6)


def test_blocks_that_memory_does_not_hold_are_read_again(spark, monkeypatch):
    rows = spark.range(600).selectExpr("id k", "array(id / 7D, id % 2) a", "cast(id % 2 as int) y")
    df = rows.withColumn("features", array_to_vector("a"))
    how = perceptron.Perceptron(hidden=(3,), epochs=2)
    (kept,) = perceptron.fit(df, [how], "y", "k")
    monkeypatch.setattr(perceptron, "KEPT_BYTES", 0)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    found = perceptron.Rows(df, "y", "k", "features", None, None, 256)
    assert not found.kept and spark.sparkContext._jsc.getPersistentRDDs().size() == before
    found.close()
    (read,) = perceptron.fit(df, [how], "y", "k")
    assert read.flat == pytest.approx(kept.flat, abs=1e-12)
