"""Quality classifier: Gaussian kernel by random Fourier features, ridge scores, isotonic calibration.

A document is a vector of statistics of its whole text. A bounded sample of labelled documents
(``SAMPLE_ROWS``, by hash of the id) is enough for the fit: tasks sum the moments, then the
normal equations of their rows; the sums are added row by row of the matrix and solved on the driver,
whose size depends on the number of features alone. Isotonic calibration takes labelled documents that the
ridge fit has not seen, counted in a fixed number of score bins. Then one pass scores everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.llm.common import crc_bucket, slices, staged, texts_of

FOLDS = 5
#: The fold that is never learned from, and the one that calibrates.
HELD_OUT, CALIBRATES = 0, 1
#: Labelled documents that the fit reads at most.
SAMPLE_ROWS = 20_000
FEATURES = 256
RIDGE = 1e-3
BINS = 1000
THRESHOLD = 0.3

_CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r",
    b".,;:'\"-()", b"!?", b"#*$%&|<>", b"@/\\=+_~^`[]{}", bytes(range(128, 256)),
)
_CLASS_OF = np.zeros((256, len(_CLASSES)))
for _k, _members in enumerate(_CLASSES):
    _CLASS_OF[list(_members), _k] = 1.0
N_STATS = len(_CLASSES) + 11


def statistics(text: bytes) -> np.ndarray:
    """What the classifier sees of a text; all zero for an empty one."""
    words = text.split()
    if not words:
        return np.zeros(N_STATS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(float)
    shares = counts / len(text)
    seen = shares[shares > 0]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:], words[2:], strict=False)))
    lines = [line for line in text.split(b"\n") if line.strip()]
    more = (
        np.log1p(len(words)), np.log1p(len(text)), sizes.mean(), sizes.std(), np.log(sizes.max()),
        distinct / len(words), pairs / max(1, len(words) - 2), -(seen * np.log(seen)).sum(),
        len(set(lines)) / len(lines), np.log1p(len(words) / len(lines)), float(np.median(sizes)),
    )
    return np.append(shares @ _CLASS_OF, more)


@dataclass(frozen=True)
class Model:
    """Scale of the statistics, random frequencies, ridge weights and calibration steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """0 to 1. A thousandth of the ridge score is mixed in, so that documents of one step keep their order."""
        raw = self.raw(stats)
        step = np.interp(raw, self.knots, self.values)
        return np.clip(0.999 * step + 0.001 * np.clip(raw, 0, 1), 0.0, 1.0)


def fourier(x: np.ndarray) -> np.ndarray:
    """Random features whose inner products approximate exp(-|x - y|^2 / (2 N_STATS)), and a constant."""
    rng = np.random.default_rng(7)
    frequencies = rng.standard_normal((N_STATS, FEATURES)) / np.sqrt(N_STATS)
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    waves = np.sqrt(2 / FEATURES) * np.cos(np.clip(x, -8, 8) @ frequencies + phases)
    return np.hstack([waves, np.ones((len(x), 1))])


def isotonic(scores: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising means over bins in order of score (pool adjacent violators), as knots and values."""
    blocks: list[list[float]] = []
    for x, s, n in zip(scores, sums, counts, strict=True):
        blocks.append([x, x, s, n])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, high, s2, n2 = blocks.pop()
            blocks[-1][1] = high
            blocks[-1][2] += s2
            blocks[-1][3] += n2
    knots = [x for b in blocks for x in (b[0], b[1])]
    return np.array(knots), np.array([b[2] / b[3] for b in blocks for _ in (0, 1)])


def _examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(fold, y, stats) of at most ``SAMPLE_ROWS`` labelled documents outside the held-out fold."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    known = known.withColumn("fold", crc_bucket("doc_id", FOLDS)).where(F.col("fold") != HELD_OUT)
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("fold", "y", "text")

    def run(batches):
        for part, found in slices(batches, "text"):
            stats = pa.array([statistics(t) for t in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), stats], ["fold", "y", "stats"])

    return staged(texts.mapInArrow(run, "fold long, y double, stats array<double>"), "examples")


def _stacked(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False).reshape(-1, N_STATS) if len(column) else np.zeros((0, N_STATS))


def _summed(rows: DataFrame, make, width: int) -> np.ndarray:
    """The sum over all tasks of the matrix that ``make(y, stats)`` gives for a batch."""

    def run(batches):
        total = None
        for batch in batches:
            part = make(batch.column(0).to_numpy(zero_copy_only=False), _stacked(batch.column(1)))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "part"]
            )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": group["i"][:1], "part": [np.sum(np.stack(group["part"]), axis=0)]})

    parts = rows.select("y", "stats").mapInArrow(run, "i int, part array<double>")
    found = parts.groupBy("i").applyInPandas(add, "i int, part array<double>").collect()
    return np.array([r["part"] for r in sorted(found, key=lambda r: r["i"])]) if found else np.zeros((0, width))


def _moments(y: np.ndarray, stats: np.ndarray) -> np.ndarray:
    return np.stack([np.full(N_STATS, float(len(y))), stats.sum(axis=0), (stats**2).sum(axis=0)])


def _equations(mean: np.ndarray, scale: np.ndarray):
    def make(y: np.ndarray, stats: np.ndarray) -> np.ndarray:
        z = fourier((stats - mean) / scale)
        return np.hstack([z.T @ z, (z.T @ y)[:, None]])

    return make


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``labels`` (doc_id, quality) of ``docs`` (doc_id, text); repeated labels are averaged.

    Without any label every document scores 1, so nothing is rejected on no evidence.
    """
    rows = _examples(docs, labels)
    learn = rows.where(F.col("fold") != CALIBRATES)
    moments = _summed(learn, _moments, N_STATS)
    if not len(moments) or not moments[0, 0]:
        return Model(np.zeros(N_STATS), np.ones(N_STATS), np.zeros(FEATURES + 1), np.zeros(1), np.ones(1))
    n, mean = moments[0, 0], moments[1] / moments[0]
    scale = np.sqrt(np.maximum(moments[2] / n - mean**2, 0)) + 1e-6
    both = _summed(learn, _equations(mean, scale), FEATURES + 2)
    gram, right = both[:, :-1], both[:, -1]
    weights = np.linalg.solve(gram + RIDGE * n / FEATURES * np.eye(FEATURES + 1), right)
    bare = Model(mean, scale, weights, np.zeros(1), np.zeros(1))

    def binned(batches):
        for batch in batches:
            raw = np.clip(bare.raw(_stacked(batch.column(1))), -1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.round((raw + 1) / 3 * BINS).astype(np.int64)), batch.column(0)], ["bin", "y"]
            )

    held = rows.where(F.col("fold") == CALIBRATES)
    source = learn if held.isEmpty() else held
    bins = source.select("y", "stats").mapInArrow(binned, "bin long, y double").groupBy("bin")
    counted = sorted(bins.agg(F.sum("y").alias("s"), F.count("*").alias("n")).collect())
    at, sums, counts = (np.array(c, float) for c in zip(*counted, strict=True))
    knots, values = isotonic(at / BINS * 3 - 1, sums, counts)
    return Model(mean, scale, weights, knots, values)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; null text counts as empty."""

    def run(batches):
        for part, texts in slices(batches, "text"):
            score = model.score(np.stack([statistics(t) for t in texts]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    held = (crc_bucket("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text")
    return slim.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(text: str, model: Model) -> Column:
    """A condition on a text column: its score reaches the threshold."""

    @F.arrow_udf("boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            stats = [statistics(t) for t in texts_of(batch)]
            yield pa.array(model.score(np.stack(stats)) >= THRESHOLD if stats else [], pa.bool_())

    return run(F.col(text))


def keep_accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that a model fitted on them and their labels accepts."""
    return docs.where(accepted("text", fit(docs, labels)))
