"""The distributed network against a single-process run, its parameters, its state and its artifact."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import network as NN
from tessera.operators.train import fit_grid, load_model

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)) * [1, 5, 0.1, 1] + [0, 2, 0, 0]
    y = (x[:, 0] + x[:, 3] + 0.2 * (x[:, 1] - 2) > 0).astype(float)
    data = [(f"C{i:04d}", *map(float, x[i, :3]), None if i % 17 == 0 else float(x[i, 3]), 0.0, float(y[i])) for i in range(400)]
    return spark.createDataFrame(data, "customer_id string, a double, b double, c double, d double, e double, churn double").repartition(5).persist()


def blocks_of(rows, partitions=5, features=FEATURES):
    scaling = NN.fit_scaling(rows, features)
    return NN.training_blocks(rows.repartition(partitions), scaling, "churn", "customer_id").persist(), scaling


def single_process(rows, features, hidden_units, dropout, epochs, batch_size, seed=42, sample_rows=16):
    """The same batches, masks and Adam, row by row in one process."""
    table = rows.select(F.xxhash64("customer_id").alias("key"), "churn", *features).toPandas()
    x = table[features].astype(float)
    mean = x.mean()
    filled = x.fillna(mean)
    scale = filled.std(ddof=0).replace(0, 1)
    x, y, keys = ((filled - mean) / scale).to_numpy(), table["churn"].to_numpy(), table["key"].to_numpy().view(np.uint64)
    k, h = len(features), hidden_units
    w = NN.initial_weights(k, h, seed)
    w1, b1, w2, b2 = w[:k * h].reshape(k, h).copy(), w[k * h:k * h + h].copy(), w[k * h + h:-1].copy(), w[-1:].copy()
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w1, b1, w2, b2)]
    steps, t = math.ceil(sample_rows / min(batch_size, sample_rows)), 0
    for epoch in range(epochs):
        batch, spare = NN.step_of(keys, epoch, steps, seed), NN.spared(keys, h, epoch, dropout, seed)
        for step in range(steps):
            rows_of = np.flatnonzero(batch == step)
            if not len(rows_of):
                continue
            slopes = [np.zeros_like(p) for p in (w1, b1, w2, b2)]
            for i in rows_of:
                z = np.array([sum(x[i, f] * w1[f, j] for f in range(k)) + b1[j] for j in range(h)])
                active = np.where(z > 0, z, 0) * spare[i]
                error = 1 / (1 + math.exp(-(active @ w2 + b2[0]))) - y[i]
                back = error * w2 * spare[i] * (z > 0)
                for s, add in zip(slopes, (np.outer(x[i], back), back, error * active, np.array([error]))):
                    s += add / len(rows_of)
            t += 1
            for p, s, m in zip((w1, b1, w2, b2), slopes, moments):
                m[0] = 0.9 * m[0] + 0.1 * s
                m[1] = 0.999 * m[1] + 0.001 * s * s
                p -= 0.001 * math.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t) * m[0] / (np.sqrt(m[1]) + 1e-7)
    return np.concatenate((w1.ravel(), b1, w2, b2))


@pytest.mark.parametrize("dropout,batch_size", [(0.0, 16), (0.3, 8), (0.5, 3)])
def test_equals_a_single_process_run(rows, dropout, batch_size):
    features = [*FEATURES, "e"]
    blocks, scaling = blocks_of(rows, features=features)
    params = dict(hidden_units=6, dropout=dropout, epochs=3, batch_size=batch_size)
    want = single_process(rows, features, **params)
    assert np.abs(NN.fit_network(blocks, scaling, **params).weights - want).max() < 1e-6


def test_partitions_and_tree_do_not_matter(rows):
    params = dict(hidden_units=5, dropout=0.2, epochs=2, batch_size=8)
    first = NN.fit_network(*blocks_of(rows, 1), **params).weights
    for partitions, fan_in in ((7, 64), (7, 2), (3, 3)):
        assert np.abs(NN.fit_network(*blocks_of(rows, partitions), fan_in=fan_in, **params).weights - first).max() < 1e-9


def test_every_grid_parameter_changes_the_fit(rows):
    blocks, scaling = blocks_of(rows)
    base = dict(hidden_units=5, dropout=0.2, epochs=2, batch_size=8)
    fits = [NN.fit_network(blocks, scaling, **{**base, **change}).weights
            for change in ({}, {"hidden_units": 6}, {"dropout": 0.4}, {"epochs": 3}, {"batch_size": 4}, {"seed": 1})]
    for i, a in enumerate(fits):
        for b in fits[:i]:
            assert len(a) != len(b) or np.abs(a - b).max() > 1e-6
    for wrong in ({"dropout": 1.0}, {"batch_size": 0}, {"epochs": 0}):
        with pytest.raises(ValueError):
            NN.fit_network(blocks, scaling, **{**base, **wrong})


def test_a_fit_goes_on_from_its_state(rows, tmpdir_fresh):
    blocks, scaling = blocks_of(rows)
    params = dict(hidden_units=5, dropout=0.2, batch_size=8, state_every=2)
    whole = NN.fit_network(blocks, scaling, epochs=6, **params).weights
    state = f"{tmpdir_fresh}/state"
    NN.fit_network(blocks, scaling, epochs=5, state=state, **params)  # ends after a state of four epochs
    calls = []
    slope_of, NN.slope_of = NN.slope_of, lambda *a, **k: (calls.append(k["epoch"]), slope_of(*a, **k))[1]
    try:
        again = NN.fit_network(blocks, scaling, epochs=6, state=state, **params).weights
    finally:
        NN.slope_of = slope_of
    assert sorted(set(calls)) == [4, 5] and np.abs(again - whole).max() < 1e-9
    with pytest.raises(ValueError, match="layers"):
        NN.fit_network(blocks, scaling, epochs=6, state=state, **{**params, "hidden_units": 4})


def test_it_learns_and_its_artifact_scores_alike(spark, rows, tmpdir_fresh):
    gold = rows.withColumn("_split", F.when(F.abs(F.hash("customer_id")) % 4 == 0, "val").otherwise("train")).withColumn("churn", F.col("churn").cast("int"))
    runs = fit_grid(spark, gold, "neural_network", [{"hidden_units": 32, "dropout": 0.1, "epochs": 20, "batch_size": 8}], "exp",
                    model_root=f"{tmpdir_fresh}/models", features=FEATURES).collect()
    run = runs[0]
    assert run.metrics["val_auc"] > 0.8 and run.params == {"hidden_units": "32", "dropout": "0.1", "epochs": "20", "batch_size": "8"}
    model = load_model(run.model_path)
    scored = model.transform(gold.select("customer_id", *FEATURES)).collect()
    assert len(scored) == 400 and all(0 <= r.probability[1] <= 1 and abs(r.probability.values.sum() - 1) < 1e-12 for r in scored)


def test_no_rows_and_missing_features(spark, rows):
    blocks, scaling = blocks_of(rows.limit(0))
    model = NN.fit_network(blocks, scaling, hidden_units=3, dropout=0.0, epochs=1, batch_size=8)
    assert (model.weights == NN.initial_weights(4, 3, 42)).all()
    nothing = spark.createDataFrame([(None, None, None, None)], "a double, b double, c double, d double")
    assert 0 <= model.transform(nothing).first().probability[1] <= 1


def test_a_grid_descends_in_the_steps_of_its_longest_network(spark, rows, tmpdir_fresh):
    gold = rows.withColumn("_split", F.when(F.abs(F.hash("customer_id")) % 4 == 0, "val").otherwise("train"))
    grid = [{"hidden_units": 4, "dropout": 0.2, "epochs": 2, "batch_size": 8}, {"hidden_units": 7, "dropout": 0.0, "epochs": 3, "batch_size": 8},
            {"hidden_units": 4, "dropout": 0.2, "epochs": 3, "batch_size": 8}]
    calls = []
    slope_of, NN.slope_of = NN.slope_of, lambda *a, **k: (calls.append((k["epoch"], k["step"])), slope_of(*a, **k))[1]
    try:
        runs = fit_grid(spark, gold, "neural_network", grid, "exp", model_root=f"{tmpdir_fresh}/models", features=FEATURES).collect()
    finally:
        NN.slope_of = slope_of
    assert calls == [(epoch, step) for epoch in range(3) for step in range(2)]  # one job a step, not one for each network
    assert [r.params["epochs"] for r in runs] == ["2", "3", "3"] and len({r.run_id for r in runs}) == 3
    train = gold.filter("_split = 'train'")
    for r, params in zip(runs, grid):
        assert np.abs(load_model(r.model_path).weights - single_process(train, FEATURES, **params)).max() < 1e-6


def test_networks_of_other_batches_seeds_and_states_fit_as_alone(rows, tmpdir_fresh):
    blocks, scaling = blocks_of(rows)
    base = dict(hidden_units=5, dropout=0.3, epochs=3, batch_size=8)
    state = f"{tmpdir_fresh}/state"
    NN.fit_network(blocks, scaling, **{**base, "epochs": 2}, state=state, state_every=2)  # the last one goes on from epoch 2
    grid = [base, {**base, "batch_size": 4}, {**base, "seed": 1}, {**base, "hidden_units": 9}, {**base, "state": state, "state_every": 2}]
    for model, params in zip(NN.fit_networks(blocks, scaling, grid), grid):
        alone = NN.fit_network(blocks, scaling, **{k: v for k, v in params.items() if not k.startswith("state")})
        assert np.abs(model.weights - alone.weights).max() < 1e-9


def test_slices_of_a_block_add_up():
    keys = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x, y = np.random.default_rng(1).normal(size=(1000, 4)), np.arange(1000) % 3 / 2.0
    network = NN.Network(NN.initial_weights(4, 6, 42) + 0.05, 6, 0.25)
    blocks = NN.pa.RecordBatch.from_arrays([NN.pa.array([c.tobytes()], NN.pa.binary()) for c in (keys, y, x)], names=["keys", "labels", "x"])
    mine = NN.step_of(keys, 1, 2, 42) == 0
    want = NN.gradient(np.column_stack((x, np.ones(1000)))[mine], y[mine], NN.draws(keys[mine], 6, 1, 42), network)
    size, NN.SLICE = NN.SLICE, 6
    try:
        out = next(NN._partial([blocks], networks=[network], epoch=1, step=0, steps=2, seed=42))
    finally:
        NN.SLICE = size
    assert out.column(0)[0].as_py() == mine.sum() and np.abs(np.frombuffer(out.column(1)[0].as_py()) - want).max() < 1e-9


def shards_of(rows, partitions=5, features=FEATURES, key="customer_id"):
    scaling = NN.fit_scaling(rows, features)
    return NN.training_shards(rows.repartition(partitions), scaling, "churn", key).persist(), scaling


def by_rows(blocks, hidden_units, dropout, epochs, batch_size, seed=42):
    """The same descent in one process: shards, rows and mini-batches in their order, the gradient and the step that the tests above hold."""
    shards = [([], [], []) for _ in range(blocks.rdd.getNumPartitions())]
    for r in blocks.withColumn("shard", F.spark_partition_id()).collect():
        for of, values, kind in zip(shards[r.shard], (r.keys, r.labels, r.x), (np.uint64, float, float)):
            of.append(np.frombuffer(values, kind))
    shards = [[np.concatenate(of) for of in shard] for shard in shards if shard[0]]
    ids = np.array([i for i, n in enumerate(blocks.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()) if n], np.uint64)
    k = sum(len(x) for *_, x in shards) // sum(len(keys) for keys, *_ in shards)
    w = NN.initial_weights(k, hidden_units, seed)
    adam = NN.Adam(w, np.zeros(len(w)), np.zeros(len(w)), 0)
    for epoch in range(epochs):
        walk = []
        for i in np.argsort(NN.mixed(ids ^ NN._salt(seed, 3, epoch))):
            keys, y, x = shards[i]
            walk += [(keys[j], y[j], x.reshape(-1, k)[j]) for j in np.argsort(NN.mixed(keys ^ NN._salt(seed, 1, epoch)))]
        for i in range(0, len(walk), batch_size):
            keys, y, x = map(np.array, zip(*walk[i:i + batch_size]))
            slope = NN.gradient(np.column_stack((x, np.ones(len(x)))), y, NN.draws(keys, hidden_units, epoch, seed),
                                NN.Network(adam.weights, hidden_units, dropout))
            adam = adam.after(slope / len(y))
    return adam


@pytest.mark.parametrize("shard,dropout,batch_size", [(NN.SHARD, 0.3, 8), (600, 0.3, 8), (600, 0.0, 7), (600, 0.5, 150), (600, 0.2, 1000)])
def test_mini_batches_of_rows_equal_a_single_process_run(rows, monkeypatch, shard, dropout, batch_size):
    monkeypatch.setattr(NN, "SHARD", shard)
    blocks, scaling = shards_of(rows)
    assert blocks.rdd.getNumPartitions() == math.ceil(400 * 6 / shard)
    steps, after = [], NN.Course.ended
    monkeypatch.setattr(NN.Course, "ended", lambda *a: steps.append(after(*a).steps) or after(*a))
    params = dict(hidden_units=6, dropout=dropout, epochs=3, batch_size=batch_size)
    got, want = NN.fit_network(blocks, scaling, sample_rows=None, **params), by_rows(blocks, **params)
    assert steps == [e * math.ceil(400 / batch_size) for e in (1, 2, 3)] and want.steps == steps[-1]
    assert np.abs(got.weights - want.weights).max() < 1e-9


def test_shards_do_not_hang_on_the_partitions(rows, monkeypatch):
    monkeypatch.setattr(NN, "SHARD", 700)
    params = dict(hidden_units=5, dropout=0.2, epochs=2, batch_size=8, sample_rows=None)
    first, other = (NN.fit_network(*shards_of(rows, n), **params).weights for n in (1, 7))
    assert np.abs(first - other).max() < 1e-9


@pytest.mark.parametrize("key", [None, "C"])
def test_rows_without_key_and_rows_alike_spread_over_the_shards(spark, rows, monkeypatch, key):
    monkeypatch.setattr(NN, "SHARD", 600)
    alike = spark.createDataFrame([(key, 1.0, 2.0, None, 3.0, 0.0, 1.0)] * 300, rows.schema)
    some = rows.withColumn("customer_id", F.lit(key).cast("string")).unionByName(alike)
    blocks, scaling = shards_of(some)
    sizes, keys = [], []
    for r in blocks.groupBy(F.spark_partition_id()).agg(F.collect_list("keys").alias("keys")).collect():
        keys += (own := [k for b in r.keys for k in np.frombuffer(b, np.uint64).tolist()])
        sizes.append(len(own))
    assert len(sizes) == 7 and sum(sizes) == len(set(keys)) == 700 and max(sizes) < 180
    params = dict(hidden_units=4, dropout=0.2, epochs=2, batch_size=8)
    assert np.abs(NN.fit_network(blocks, scaling, sample_rows=None, **params).weights - by_rows(blocks, **params).weights).max() < 1e-9


def test_slices_and_pieces_of_mini_batches_add_up(monkeypatch):
    keys = np.arange(500, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x, y = np.column_stack((np.random.default_rng(1).normal(size=(500, 4)), np.ones(500))), np.arange(500) % 2 / 1.0
    w = NN.initial_weights(4, 6, 42) + 0.05
    start = NN.Course(NN.Adam(w, np.zeros(len(w)), np.zeros(len(w)), 0), np.zeros(len(w)), 0)
    rest = (6, 0.25, 90, 1, 42)  # 90 rows in slices of 64
    monkeypatch.setattr(NN, "SLICE", 6)
    whole, half = NN.walked(start, x, y, keys, *rest), NN.walked(start, x[:237], y[:237], keys[:237], *rest)
    parts = NN.walked(half, x[237:], y[237:], keys[237:], *rest)
    adam = start.adam
    for i in range(0, 500, 90):
        of = slice(i, i + 90)
        adam = adam.after(NN.gradient(x[of], y[of], NN.draws(keys[of], 6, 1, 42), NN.Network(adam.weights, 6, 0.25)) / len(y[of]))
    for course, rows in ((whole, 50), (parts, 50), (half, 57)):
        assert course.rows == rows and course.adam.steps == (2 if course is half else 5)
    assert (start.adam.weights == w).all() and not start.slope.any()
    for course in (whole, parts):
        ended = course.ended(90)
        assert ended.steps == adam.steps == 6 and all(np.abs(a - b).max() < 1e-12 for a, b in zip(ended[:3], adam[:3]))


def test_a_fit_by_rows_goes_on_from_its_state_and_beside_others(rows, tmpdir_fresh, monkeypatch):
    monkeypatch.setattr(NN, "SHARD", 1300)
    blocks, scaling = shards_of(rows)
    base = dict(hidden_units=5, dropout=0.2, batch_size=8)
    state = dict(state=f"{tmpdir_fresh}/state", state_every=1)
    NN.fit_network(blocks, scaling, epochs=1, sample_rows=None, **base, **state)
    after, epochs = NN.course_after, []
    monkeypatch.setattr(NN, "course_after", lambda *a, **k: (epochs.append(k["epoch"]), after(*a, **k))[1])
    again, share = NN.fit_networks(blocks, scaling, [{**base, "epochs": 3, "sample_rows": None, **state}, {**base, "epochs": 2, "sample_rows": 16}])
    assert epochs == [1, 1, 2, 2]
    assert np.abs(again.weights - by_rows(blocks, epochs=3, **base).weights).max() < 1e-9
    assert np.abs(share.weights - NN.fit_network(blocks, scaling, epochs=2, **base).weights).max() < 1e-9
    empty, scaling = shards_of(rows.limit(0))
    assert (NN.fit_network(empty, scaling, epochs=1, sample_rows=None, **base).weights == NN.initial_weights(4, 5, 42)).all()


@pytest.mark.parametrize("query", ["nn_grid_runs", "registered_model_scoring"])
def test_the_queries_step_after_every_batch_size_rows(spark, tmpdir_fresh, monkeypatch, query):
    from tessera import config as C
    from tessera.operators import train as TR
    from tessera.plans import model_queries as MQ
    from tessera.plans.queries import gold_churn

    customers = [(i, f"c{i}", i % 25, 97.5 * i, ("BUILDING", "MACHINERY", "AUTOMOBILE")[i % 3]) for i in range(90)]
    orders = [(3 * i + j, i, "OF"[i % 2], 1000.0 + i, dt.datetime(1999 + (i + j) % 4, 1 + i % 12, 1), "1-URGENT") for i in range(90) for j in range(1 + i % 3)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(
        f"{tmpdir_fresh}/customer.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                          "o_orderpriority string").write.parquet(f"{tmpdir_fresh}/orders.parquet")
    grid = ({"hidden_units": 4, "dropout": 0.2, "epochs": 2, "batch_size": 8}, {"hidden_units": 5, "dropout": 0.0, "epochs": 3, "batch_size": 8})
    monkeypatch.setattr(C, "NN_GRID", grid)
    fit, runs = TR.fit_grid, []
    monkeypatch.setattr(TR, "fit_grid", lambda *a, **k: (runs.append(fit(*a, **k)), runs[-1])[1])
    assert getattr(MQ, f"q_{query}")(spark, tmpdir_fresh).count()
    train = gold_churn(spark, tmpdir_fresh).filter("_split = 'train'").withColumn("churn", F.col("churn").cast("double"))
    blocks, _ = shards_of(train, features=list(C.GOLD_FEATURES))
    for run, params in zip(runs[0].collect(), grid):
        want = by_rows(blocks, **params)
        assert want.steps == params["epochs"] * math.ceil(train.count() / 8) > 2 * params["epochs"]
        assert np.abs(load_model(run.model_path).weights - want.weights).max() < 1e-9
