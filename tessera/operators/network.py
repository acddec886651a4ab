"""The one-hidden-layer network (M4): dense ReLU, dropout, dense sigmoid; binary cross-entropy and Adam, on mini-batches.

Synchronous data-parallel descent: the training rows are packed once into blocks, and a step is one
Spark job in which every block adds up the gradient of its rows of the mini-batch; the sums of the partitions meet
in a tree of ``fan_in``, and the driver, which holds nothing but the weights and Adam's two moments, takes the step.
Networks of a grid whose epochs have the same mini-batches descend together: a step's job reads the blocks once for all of
them.  A block's rows are worked off in slices whose hidden units fit a core's cache.

A row's mini-batch in an epoch, and which hidden units its dropout spares, are hashes of the row's key,
the epoch and the seed.  They depend neither on the partitioning nor on which executor computes them, so a task run again
gives the same gradient.  With ``state``, weights and moments are committed as a dataset every
``state_every`` epochs, and a fit that finds such a state goes on from it.

With ``sample_rows`` given, ``batch_size`` is meant for a training sample of so many rows; on any table a step takes the same
share of the rows, ``batch_size / sample_rows``, so an epoch has ``ceil(sample_rows / batch_size)`` steps however large the table.

Where ``sample_rows`` is None, a mini-batch has ``batch_size`` rows of the table itself (the last one of an epoch what is left), so
an epoch has ``ceil(rows / batch_size)`` steps.  They cannot be taken side by side, as each needs the weights that the one before
it left, and a job for every few rows would be nearly all overhead.  So the weights go to the rows: an epoch visits the partitions of the
blocks, the shards, in an order of its own, one job each; the job's task takes the steps of the shard's rows, in the epoch's
order, and hands on weights, moments and the gradient of the mini-batch begun.  A task holds one shard, no task the
table, and the networks of a grid are on their way at the same time.  ``training_shards`` deals the rows at random by a hash of their keys.

Missing features take the training mean; features are scaled by mean and population deviation (1 if that is 0), both kept in
the artifact.
"""

from __future__ import annotations

import functools
import math
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package
from ..sources.tables import VersionedDataset

#: Adam's constants and the initial step size.
LEARNING_RATE, BETA_1, BETA_2, EPSILON = 0.001, 0.9, 0.999, 1e-7
#: Hidden units (rows by units of the widest network) of one slice of a block.
SLICE = 1 << 16
#: Values (rows by columns) of a shard.
SHARD = 1 << 22
_STATE = "epoch int, steps long, layers array<int>, weights array<double>, moment_1 array<double>, moment_2 array<double>"
_COURSE = "rows long, steps long, state array<binary>"
_ARTIFACT = "features array<string>, layers array<int>, weights array<double>, mean array<double>, scale array<double>"


# -- what each row does, by hash -------------------------------------------------

def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (unsigned)."""
    x = x ^ x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _salt(*numbers: int) -> np.uint64:
    salt = np.zeros(1, np.uint64)
    for n in numbers:
        salt = mixed(salt * np.uint64(31) + np.uint64(n + 1))
    return salt[0]


def step_of(keys: np.ndarray, epoch: int, steps: int, seed: int) -> np.ndarray:
    """The mini-batch of each row in an epoch."""
    return (mixed(keys ^ _salt(seed, 1, epoch)) % np.uint64(steps)).astype(np.int64)


def draws(keys: np.ndarray, units: int, epoch: int, seed: int) -> np.ndarray:
    """64 bits for each hidden unit of each row; networks of one seed share them, whatever their width."""
    return mixed(keys[:, None] ^ mixed(np.arange(1, units + 1, dtype=np.uint64) ^ _salt(seed, 2, epoch)))


def stays(bits: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the upper 53 bits, as a fraction, are at least ``dropout``."""
    return bits >= np.uint64(math.ceil(dropout * 2.0 ** 53) << 11)


def spared(keys: np.ndarray, units: int, epoch: int, dropout: float, seed: int) -> np.ndarray:
    """What each hidden unit of each row is multiplied by: 0, or 1 over the share that dropout spares."""
    return stays(draws(keys, units, epoch, seed), dropout) / (1 - dropout)


# -- the network -----------------------------------------------------------------

def initial_weights(inputs: int, units: int, seed: int) -> np.ndarray:
    """Glorot-uniform weights and zero biases, as one vector: hidden weights, hidden biases, output weights, output bias."""
    rng = np.random.default_rng(seed)
    hidden, out = math.sqrt(6 / (inputs + units)), math.sqrt(6 / (units + 1))
    return np.concatenate((rng.uniform(-hidden, hidden, inputs * units), np.zeros(units), rng.uniform(-out, out, units), np.zeros(1)))


def _parts(weights: np.ndarray, inputs: int, units: int):
    a, b = inputs * units, inputs * units + units
    return weights[:a].reshape(inputs, units), weights[a:b], weights[b:b + units], weights[b + units]


def probabilities(x: np.ndarray, weights: np.ndarray, units: int) -> np.ndarray:
    w1, b1, w2, b2 = _parts(weights, x.shape[1], units)
    return 1 / (1 + np.exp(-np.clip(np.maximum(x @ w1 + b1, 0) @ w2 + b2, -700, 700)))


class Network(NamedTuple):
    """What a gradient is taken of."""
    weights: np.ndarray
    units: int
    dropout: float


def gradient(x: np.ndarray, y: np.ndarray, bits: np.ndarray, network: Network) -> np.ndarray:
    """Gradient of the summed cross-entropy of some rows; ``x`` ends in a column of ones, ``bits`` are ``draws`` of enough units."""
    weights, units, dropout = network
    k, times = x.shape[1] * units, 1 / (1 - dropout)
    w1, w2, b2 = weights[:k].reshape(-1, units), weights[k:k + units], weights[k + units]  # the biases are the last row of w1
    hidden = x @ w1
    on = hidden > 0
    if dropout:
        on &= stays(bits[:, :units], dropout)
    on = on.astype(float)
    hidden *= on
    error = 1 / (1 + np.exp(-np.clip(hidden @ w2 * times + b2, -700, 700))) - y
    return np.concatenate((((x * error[:, None]).T @ on * (w2 * times)).ravel(), error @ hidden * times, [error.sum()]))


class Adam(NamedTuple):
    weights: np.ndarray
    moment_1: np.ndarray
    moment_2: np.ndarray
    steps: int

    def after(self, slope: np.ndarray, rate: float = LEARNING_RATE) -> "Adam":
        t = self.steps + 1
        m = BETA_1 * self.moment_1 + (1 - BETA_1) * slope
        v = BETA_2 * self.moment_2 + (1 - BETA_2) * slope * slope
        rate = rate * math.sqrt(1 - BETA_2 ** t) / (1 - BETA_1 ** t)
        return Adam(self.weights - rate * m / (np.sqrt(v) + EPSILON), m, v, t)


class Course(NamedTuple):
    """A network within an epoch of small mini-batches.  Of the one begun: the sum of the gradients, over a whole one's rows, and the number of rows."""
    adam: Adam
    slope: np.ndarray
    rows: int

    def ended(self, batch_size: int) -> Adam:
        """The optimiser after a last step with the rows that fill no mini-batch."""
        return self.adam.after(self.slope * (batch_size / self.rows)) if self.rows else self.adam


def walked(course: Course, x: np.ndarray, y: np.ndarray, keys: np.ndarray, units: int, dropout: float, batch_size: int, epoch: int, seed: int) -> Course:
    """The course after these rows, taken as they come; ``x`` ends in a column of ones.

    A step on a few rows is so little work that new arrays would be most of it: all is done in place, dropout is drawn for a
    slice of rows, and the moments are kept without their factors ``1 - BETA``."""
    (weights, m, v, steps), total, begun = course
    weights, m, v, total = weights.copy(), m / (1 - BETA_1), v / (1 - BETA_2), total.copy()
    k, size, times = x.shape[1] * units, max(64, SLICE // units), 1 / (1 - dropout)
    slope, change, out = np.empty_like(weights), np.empty_like(weights), np.empty(units)
    w1, w2, b2 = weights[:k].reshape(-1, units), weights[k:k + units], weights[k + units:]  # the biases are the last row of w1
    slope_1, slope_2, slope_b2 = slope[:k].reshape(-1, units), slope[k:k + units], slope[k + units:]
    most = min(batch_size, size)
    zeros, hiddens, ons, errors, weighted = np.zeros((most, units)), np.empty((most, units)), np.empty((most, units)), np.empty(most), np.empty((most, x.shape[1]))
    share, epsilon, y, at, n = 1 / batch_size, EPSILON / math.sqrt(1 - BETA_2), y - 0.5, 0, len(y)
    add, subtract, multiply, divide, dot = np.add, np.subtract, np.multiply, np.divide, np.dot
    while at < n:
        first, end = at, min(at + size, n)
        spares = stays(draws(keys[first:end], units, epoch, seed), dropout) * times if dropout else None
        while at < end:
            to = min(at + batch_size - begun, end)
            rows, inputs = to - at, x[at:to]
            hidden, on, error, errors_by = hiddens[:rows], ons[:rows], errors[:rows], weighted[:rows]
            np.maximum(dot(inputs, w1, out=hidden), zeros[:rows], out=hidden)
            if dropout:
                multiply(hidden, spares[at - first:to - first], out=hidden)
            add(dot(hidden, w2, out=error), b2, out=error)
            multiply(error, 0.5, out=error)
            np.tanh(error, out=error)  # of half the sum; half of it and a half more is the sigmoid
            multiply(error, 0.5, out=error)
            subtract(error, y[at:to], out=error)
            multiply(error, share, out=error)
            multiply(np.sign(hidden, out=on), multiply(w2, times, out=out), out=on)
            dot(multiply(inputs, error[:, None], out=errors_by).T, on, out=slope_1)
            dot(error, hidden, out=slope_2)
            slope_b2[0] = error.sum()
            at = to
            if begun + rows < batch_size:
                add(total, slope, out=total)
                begun += rows
                continue
            if begun:
                add(slope, total, out=slope)
                total[:], begun = 0, 0
            steps += 1
            multiply(m, BETA_1, out=m)
            add(m, slope, out=m)
            multiply(v, BETA_2, out=v)
            add(v, multiply(slope, slope, out=slope), out=v)
            add(np.sqrt(v, out=change), epsilon, out=change)
            divide(m, change, out=change)
            rate = LEARNING_RATE * math.sqrt(1 - BETA_2 ** steps) / (1 - BETA_1 ** steps) * (1 - BETA_1) / math.sqrt(1 - BETA_2)
            subtract(weights, multiply(change, rate, out=change), out=weights)
    return Course(Adam(weights, m * (1 - BETA_1), v * (1 - BETA_2), steps), total, begun)


# -- blocks of rows ----------------------------------------------------------------

def _matrix(batch: pa.RecordBatch, first: int) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[first:]])


def _pack(batches):
    """(key, label, features...) rows to blocks: keys, labels and the matrix as bytes."""
    for batch in batches:
        if len(batch):
            columns = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch, 2)
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names=["keys", "labels", "x"])


class Scaling(NamedTuple):
    features: list[str]
    mean: list[float]
    scale: list[float]


def fit_scaling(train: DataFrame, features) -> Scaling:
    """Mean and population deviation of each feature, missing values at the mean; one pass."""
    aggregates = [a for f in features for a in (F.avg(f), F.var_pop(f), F.count(f))]
    found = list(train.agg(F.count(F.lit(1)), *aggregates).first())
    n, each = found[0], [found[1 + 3 * i:4 + 3 * i] for i in range(len(features))]
    scale = [math.sqrt(v * k / n) if v else 1.0 for _, v, k in each]
    return Scaling(list(features), [float(m or 0.0) for m, _, _ in each], [s or 1.0 for s in scale])


def _keyed(train: DataFrame, scaling: Scaling, label: str, key: Column) -> DataFrame:
    """(key, y, x0, x1...): the key, the label and the scaled features."""
    ship_package(train.sparkSession)
    columns = [((F.coalesce(F.col(f).cast("double"), F.lit(m)) - m) / s).alias(f"x{i}") for i, (f, m, s) in enumerate(zip(*scaling))]
    return train.select(key.alias("key"), F.col(label).cast("double").alias("y"), *columns)


def training_blocks(train: DataFrame, scaling: Scaling, label: str, key: str | None = None) -> DataFrame:
    """The training rows as blocks (one per Arrow batch), scaled; ``key`` names a column that tells rows apart (else all features)."""
    rows = _keyed(train, scaling, label, F.xxhash64(*([key] if key else [*scaling.features, label])))
    return rows.mapInArrow(_pack, "keys binary, labels binary, x binary")


def training_shards(train: DataFrame, scaling: Scaling, label: str, key: str | None = None) -> DataFrame:
    """``training_blocks`` dealt at random to partitions of about ``SHARD`` values.  A row's place hangs on its key (its contents
    if that is null) and the number of shards alone; rows of one key are numbered, so that they too are dealt and shuffled apart."""
    contents = F.xxhash64(*scaling.features, label)
    rows = _keyed(train, scaling, label, F.when(F.col(key).isNull(), contents).otherwise(F.xxhash64(key)) if key else contents)
    alike = F.row_number().over(Window.partitionBy("key").orderBy(*rows.columns[1:]))
    shards = max(1, math.ceil(train.count() * len(rows.columns) / SHARD))
    return rows.withColumn("key", F.xxhash64("key", alike)).repartition(shards, "key").mapInArrow(_pack, "keys binary, labels binary, x binary")


def spread(blocks: DataFrame) -> DataFrame:
    """The blocks dealt evenly to about as many partitions as they have, in whole rounds of the cores."""
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    return blocks.repartition(max(1, round(blocks.rdd.getNumPartitions() / cores)) * cores)


def _partial(batches, networks: list[Network], epoch: int, step: int, steps: int, seed: int):
    """The gradients, end to end, of the partition's rows of one mini-batch, and how many rows they are."""
    total, n = [np.zeros(len(network.weights)) for network in networks], 0
    widest = max([network.units for network in networks if network.dropout], default=0)
    size = max(64, SLICE // max(network.units for network in networks))
    for batch in batches:
        for keys, labels, x in zip(*batch.columns):
            keys, labels, x = np.frombuffer(keys.as_buffer(), np.uint64), np.frombuffer(labels.as_buffer()), np.frombuffer(x.as_buffer())
            x = x.reshape(len(keys), -1)
            mine = np.flatnonzero(step_of(keys, epoch, steps, seed) == step)
            for rows in (mine[i:i + size] for i in range(0, len(mine), size)):
                inputs, y = np.column_stack((x[rows], np.ones(len(rows)))), labels[rows]
                bits = draws(keys[rows], widest, epoch, seed)
                for slope, network in zip(total, networks):
                    slope += gradient(inputs, y, bits, network)
            n += len(mine)
    if n:
        slopes = np.concatenate(total).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([slopes], pa.binary())], names=["n", "slope"])


def _added(batches):
    """Sum of partial gradients."""
    n, total = 0, None
    for batch in batches:
        for rows, slope in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            slope = np.frombuffer(slope)
            n, total = n + rows, slope if total is None else total + slope
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["n", "slope"])


def slope_of(blocks: DataFrame, partitions: int, fan_in: int, **step) -> tuple[int, np.ndarray | None]:
    """Rows and summed gradients, end to end, of one mini-batch."""
    sums = blocks.mapInArrow(functools.partial(_partial, **step), "n long, slope binary")
    while partitions > fan_in:
        partitions = -(-partitions // fan_in)
        sums = sums.repartition(partitions).mapInArrow(_added, "n long, slope binary")
    rows = sums.collect()  # fan_in vectors at most
    return sum(r.n for r in rows), sum(np.frombuffer(r.slope) for r in rows) if rows else None


def _walk(batches, course: Course, units: int, dropout: float, batch_size: int, epoch: int, seed: int):
    """The course after the rows of a shard, in the order they have in the epoch."""
    blocks = [[c.as_buffer() for c in block] for batch in batches for block in zip(*batch.columns)]
    if blocks:
        keys, labels, x = (np.concatenate([np.frombuffer(b, kind) for b in of]) for of, kind in zip(zip(*blocks), (np.uint64, float, float)))
        order = np.argsort(mixed(keys ^ _salt(seed, 1, epoch)), kind="stable")
        inputs = np.ones((len(keys), len(x) // len(keys) + 1))
        inputs[:, :-1] = x.reshape(len(keys), -1)[order]
        course = walked(course, inputs, labels[order], keys[order], units, dropout, batch_size, epoch, seed)
    adam, slope, rows = course
    state = [a.tobytes() for a in (adam.weights, adam.moment_1, adam.moment_2, slope)]
    yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([adam.steps]), pa.array([state], pa.list_(pa.binary()))], names=["rows", "steps", "state"])


def course_after(blocks: DataFrame, shard: int, **walk) -> Course:
    """A network's course after one shard; the job reads no other."""
    after = blocks.mapInArrow(functools.partial(_walk, **walk), _COURSE).rdd
    r = blocks.sparkSession.sparkContext.runJob(after, list, [shard])[0]
    *adam, slope = map(np.frombuffer, r.state)
    return Course(Adam(*adam, r.steps), slope, r.rows)


# -- fitting and scoring -----------------------------------------------------------

class NetworkModel:
    """A fitted network with its scaling; ``transform`` adds ``probability`` (vector of both classes) as MLlib's classifiers do."""

    def __init__(self, scaling: Scaling, units: int, weights: np.ndarray) -> None:
        self.scaling, self.units, self.weights = scaling, units, weights

    def transform(self, df: DataFrame) -> DataFrame:
        (features, mean, scale), units, weights = self.scaling, self.units, self.weights
        mean, scale = np.array(mean), np.array(scale)

        @F.pandas_udf("double")
        def positive(x: pd.DataFrame) -> pd.Series:
            x = x.to_numpy(float)
            return pd.Series(probabilities((np.where(np.isnan(x), mean, x) - mean) / scale, weights, units))

        p = positive(F.struct(*[F.col(f).cast("double").alias(f) for f in features]))
        return df.withColumn("probability", p).withColumn("probability", array_to_vector(F.array(1 - F.col("probability"), F.col("probability"))))

    def save(self, spark: SparkSession, path: str) -> None:
        row = (self.scaling.features, [len(self.scaling.features), self.units], self.weights.tolist(), self.scaling.mean, self.scaling.scale)
        spark.createDataFrame([row], _ARTIFACT).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/network")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "NetworkModel":
        r = spark.read.schema(_ARTIFACT).parquet(f"{path.rstrip('/')}/network").first()
        return NetworkModel(Scaling(list(r.features), list(r.mean), list(r.scale)), r.layers[1], np.array(r.weights))


def _resumed(state: VersionedDataset | None, layers: list[int]) -> tuple[int, Adam] | None:
    if state is None or state.current_version() is None:
        return None
    r = state.read().first()
    if list(r.layers) != layers:
        raise ValueError(f"the stored state is of a network of layers {list(r.layers)}, not {layers}")
    return r.epoch, Adam(np.array(r.weights), np.array(r.moment_1), np.array(r.moment_2), r.steps)


class _Descent:
    """A network on its way: parameters, optimiser and, if it is to be kept, the stored state."""

    def __init__(self, spark: SparkSession, inputs: int, hidden_units: int, dropout: float, epochs: int, batch_size: int, seed: int = 42,
                 sample_rows: int | None = 16, state: str | None = None, state_every: int = 10) -> None:
        if not 0 <= dropout < 1 or min(hidden_units, epochs, batch_size) < 1:
            raise ValueError("dropout must be in [0, 1), units, epochs and batch size at least 1")
        self.spark, self.layers, self.dropout, self.epochs, self.seed, self.state_every = spark, [inputs, hidden_units], dropout, epochs, seed, state_every
        self.batch_size, self.steps = batch_size, None if sample_rows is None else -(-sample_rows // min(batch_size, sample_rows))
        self.store = VersionedDataset(spark, state) if state else None
        weights = initial_weights(inputs, hidden_units, seed)
        self.done, self.adam = _resumed(self.store, self.layers) or (0, Adam(weights, np.zeros(len(weights)), np.zeros(len(weights)), 0))

    def network(self) -> Network:
        return Network(self.adam.weights, self.layers[1], self.dropout)

    def keep(self, epoch: int) -> None:
        """Commit the state after an epoch, where it is due."""
        if self.store and (epoch + 1) % self.state_every == 0:
            row = (epoch + 1, self.adam.steps, self.layers, self.adam.weights.tolist(), self.adam.moment_1.tolist(), self.adam.moment_2.tolist())
            self.store.write(self.spark.createDataFrame([row], _STATE).coalesce(1))
            self.store.retain(2)


def _descend(blocks: DataFrame, partitions: int, fan_in: int, together: list[_Descent]) -> None:
    """Take networks with the same mini-batches to their last epochs; a step is one job for all that are at its epoch."""
    steps, seed = together[0].steps, together[0].seed
    for epoch in range(min(d.done for d in together), max(d.epochs for d in together)):
        at = [d for d in together if d.done <= epoch < d.epochs]
        ends = np.cumsum([len(d.adam.weights) for d in at])[:-1]
        for step in range(steps if at else 0):
            n, slopes = slope_of(blocks, partitions, fan_in, networks=[d.network() for d in at], epoch=epoch, step=step, steps=steps, seed=seed)
            if n:  # a small table may leave a mini-batch empty
                for d, slope in zip(at, np.split(slopes / n, ends)):
                    d.adam = d.adam.after(slope)
        for d in at:
            d.keep(epoch)


def _descend_by_rows(blocks: DataFrame, shards: int, d: _Descent) -> None:
    """Take a network to its last epoch in mini-batches of ``batch_size`` rows; a shard is one job."""
    for epoch in range(d.done, d.epochs):
        course = Course(d.adam, np.zeros(len(d.adam.weights)), 0)
        for shard in np.argsort(mixed(np.arange(shards, dtype=np.uint64) ^ _salt(d.seed, 3, epoch))).tolist():
            course = course_after(blocks, shard, course=course, units=d.layers[1], dropout=d.dropout, batch_size=d.batch_size, epoch=epoch, seed=d.seed)
        d.adam = course.ended(d.batch_size)
        d.keep(epoch)


def fit_networks(blocks: DataFrame, scaling: Scaling, grid, fan_in: int = 64, parallelism: int = 3) -> list[NetworkModel]:
    """Fit one network per point of ``grid`` (the parameters of ``fit_network``) on ``training_blocks`` (``training_shards`` where
    ``sample_rows`` is None), which should be persisted or stored: every step or epoch reads them."""
    spark, partitions = blocks.sparkSession, blocks.rdd.getNumPartitions()
    all_of, groups = [_Descent(spark, len(scaling.features), **point) for point in grid], {}
    for d in all_of:
        if d.steps is not None:
            groups.setdefault((d.steps, d.seed), []).append(d)
    fits = [functools.partial(_descend_by_rows, blocks, partitions, d) for d in all_of if d.steps is None]
    fits += [functools.partial(_descend, blocks, partitions, fan_in, together) for together in groups.values()]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        list(pool.map(lambda fit: fit(), fits))
    return [NetworkModel(scaling, d.layers[1], d.adam.weights) for d in all_of]


def fit_network(blocks: DataFrame, scaling: Scaling, hidden_units: int, dropout: float, epochs: int, batch_size: int, seed: int = 42,
                sample_rows: int | None = 16, fan_in: int = 64, state: str | None = None, state_every: int = 10) -> NetworkModel:
    """Fit one network as ``fit_networks`` does."""
    point = dict(hidden_units=hidden_units, dropout=dropout, epochs=epochs, batch_size=batch_size, seed=seed, sample_rows=sample_rows,
                 state=state, state_every=state_every)
    return fit_networks(blocks, scaling, [point], fan_in)[0]
