"""Quality classifier: two zstandard dictionaries and a calibrated size difference.

One dictionary is built from good and one from bad labelled text.  A text is
compressed with both in pieces of ``piece`` bytes (a dictionary matters less the
longer a frame gets); each piece gives (bad size - good size) / larger size.  The
score is a logistic function, fitted on labelled rows, of the mean over the pieces
(weighted by size), the least and the greatest of them, and their spread.

The fit uses a bounded sample: per class the ``dictionary_rows`` labelled texts with
the least text hash (one piece each, from a place that the hash picks) and the next
``calibration_rows`` texts for the logistic function.  Equal texts count once in it.
Scoring reads every text whole.

Defined cases: null and empty texts are one empty piece and get a score like any
text; rows with a null label, a null id or no document teach nothing; a label table
without one of the classes (or an empty one) gives every text the share of good
labels as its score (0.5 without labels); repeated rows get equal scores; of several
labels of one id the lowest counts.  Extra columns pass through; input columns named
like an output column are replaced.

Scale: the labelled sample is found on narrow rows (id, hash); its texts are fetched
by a broadcast of at most that many keys.  Scoring is one pass with no shuffle; the
model is two dictionaries of ``dictionary_bytes`` and six numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import over, prepared, raw_bytes, sliced, staged, text_hash


@dataclass(frozen=True)
class Settings:
    dictionary_rows: int = 2500   # a class, bound of the sample for the dictionaries
    calibration_rows: int = 2500  # a class, bound of the sample for the logistic function
    sample_chars: int = 2048      # of each dictionary text
    dictionary_bytes: int = 112640
    piece: int = 512
    level: int = 3


@dataclass(frozen=True)
class Model:
    good: bytes = b""
    bad: bytes = b""
    weights: tuple[float, ...] = ()
    prior: float = 0.5
    settings: Settings = field(default_factory=Settings)


FEATURES = 5


def _compressor(dictionary: bytes, level: int):
    loaded = zstandard.ZstdCompressionDict(dictionary)
    loaded.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=loaded, write_content_size=False,
                                    write_checksum=False, write_dict_id=False).compress


def featurizer(model: Model):
    """bytes -> the features of a text."""
    good, bad = (_compressor(d, model.settings.level) for d in (model.good, model.bad))
    piece = model.settings.piece

    def features(text: bytes) -> tuple[float, ...]:
        view = [text[i:i + piece] for i in range(0, len(text), piece)] or [b""]
        g = np.fromiter((len(good(p)) for p in view), np.float64, len(view))
        b = np.fromiter((len(bad(p)) for p in view), np.float64, len(view))
        each = (b - g) / np.maximum(b, g)
        return (float((b.sum() - g.sum()) / np.maximum(b, g).sum()), float(each.min()), float(each.max()),
                float(each.std()), 1.0)

    return features


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curvature, x.T @ (weight * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", settings: Settings | None = None) -> Model:
    """Learn from the labelled rows of ``docs`` for which ``train`` (a condition on the id column) holds."""
    settings = settings or Settings()
    spark = docs.sparkSession
    prepared(spark)
    marks = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).filter(train)
             .groupBy(F.col(id_col).alias("__q_id")).agg(F.min(label_col).alias("y")))
    narrow = docs.select(F.col(id_col).alias("__q_id"), text_hash(text_col).alias("h"))
    known = narrow.join(marks, "__q_id").groupBy("h").agg(F.min("y").alias("y"), F.min("__q_id").alias("id"))
    known = staged(known, "labelled")  # narrow: a hash, a label and an id for each labelled text
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    if not counts.get(0) or not counts.get(1):
        return Model(prior=prior, settings=settings)

    both = settings.dictionary_rows + settings.calibration_rows
    sample = None
    for y in (0, 1):
        rows = known.filter(F.col("y") == y).orderBy("h").limit(min(both, counts[y]))
        sample = rows if sample is None else sample.union(rows)
    sample = staged(sample, "label-sample")
    bounds = {y: _bound(sample, y, counts[y], settings) for y in (0, 1)}
    # at most 2 * (dictionary_rows + calibration_rows) keys
    texts = docs.select(F.col(id_col).alias("__q_id"), text_hash(text_col).alias("__q_h"), F.col(text_col).alias("text")).join(
        F.broadcast(sample.withColumnsRenamed({"h": "sh", "id": "sid", "y": "sy"})),
        (F.col("__q_id") == F.col("sid")) & (F.col("__q_h") == F.col("sh")))
    texts = staged(texts.select("sy", "sh", "text").dropDuplicates(["sh"]), "label-texts")

    start = F.pmod("sh", F.greatest(F.lit(1), F.length("text") - settings.sample_chars)).cast("int") + 1
    dictionaries = {}
    for y in (0, 1):
        rows = (texts.filter((F.col("sy") == y) & (F.col("sh") <= bounds[y]))
                .select("sh", F.coalesce(F.col("text").substr(start, F.lit(settings.sample_chars)), F.lit("")).alias("t"))
                .collect())  # dictionary_rows pieces of sample_chars characters
        dictionaries[y] = _dictionary([r["t"].encode() for r in sorted(rows, key=lambda r: r["sh"])], settings)
    model = Model(dictionaries[1], dictionaries[0], (0.0,) * FEATURES, prior, settings)

    rest = texts.filter(F.when(F.col("sy") == 1, F.col("sh") > bounds[1]).otherwise(F.col("sh") > bounds[0]))
    rows = rest.select("sy", _features(model)(F.col("text")).alias("f")).collect()  # calibration_rows of five numbers
    x, y = np.array([r["f"] for r in rows]).reshape(-1, FEATURES), np.array([r["sy"] for r in rows], float)
    if len(set(y)) < 2:
        return Model(prior=prior, settings=settings)
    share = {c: (y == c).mean() for c in (0, 1)}
    weight = np.where(y == 1, prior / share[1], (1 - prior) / share[0])  # back to the real shares
    w = _logistic(x, y, weight)
    return Model(model.good, model.bad, tuple(map(float, w)), prior, settings)


def _bound(sample: DataFrame, y: int, count: int, settings: Settings) -> int:
    """The greatest hash among a class's dictionary texts; half of a small class."""
    n = min(settings.dictionary_rows, max(1, min(count, settings.dictionary_rows + settings.calibration_rows) // 2))
    return sample.filter(F.col("y") == y).orderBy("h").limit(n).agg(F.max("h")).first()[0]


def _dictionary(samples: list[bytes], settings: Settings) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train one."""
    size = min(settings.dictionary_bytes, max(256, sum(map(len, samples)) // 4))
    try:
        return zstandard.train_dictionary(size, samples, level=settings.level).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[:settings.dictionary_bytes] or b"\n"


def _features(model: Model):
    @F.arrow_udf("array<double>")
    def features(text: pa.Array) -> pa.Array:
        of = featurizer(model)
        return pa.array([of(t) for t in raw_bytes(text)], pa.list_(pa.float64()))

    return features


def _scorer(model: Model):
    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        of = featurizer(model)
        batches = sliced([pa.RecordBatch.from_arrays([text], names=["text"])], "text", 2 << 20)
        x = np.array([of(t) for part in batches for t in raw_bytes(part.column(0))]).reshape(-1, FEATURES)
        return pa.array(1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30))))

    return score


def score_quality(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``score`` (0 to 1, higher: likelier good)."""
    prepared(docs.sparkSession)
    if not model.weights:
        return over(docs, score=F.lit(float(model.prior)))
    return over(docs, score=_scorer(model)(F.col(f"`{text_col}`")))
