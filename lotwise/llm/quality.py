"""Quality of documents from a linear-chain conditional random field over their lines.

Every line is good or bad.  The score of a line's state comes from its own features and those
of the lines before and after it (shares of kinds of characters, word lengths, repeated
words, repeated characters, length; each in bins), the score of two neighbouring states from a
2 x 2 table.  Forward-backward gives each line's probability of being good; their mean,
weighted by line length, is turned into the document's score by a logistic curve.

Learning: labels exist for documents only, so a training document's lines all take its label.
At most ``TRAIN_DOCS`` labelled documents, those with the smallest hash of the id among the
ones with at most ``TRAIN_LINES`` lines, give their line features to the driver; the field
(gradient steps on the exact likelihood) and the curve are fitted there.  Scoring needs no
shuffle and reads whole texts; labels, language, source and id are no inputs of a score.

Defined results: a null text is an empty one, a single empty line with a score like any other;
repeated rows score the same; label rows without quality are left out, several for one
document count by their mean; without any training row every score is 0.5; a row without
an id isn't held out and isn't learned from; an empty table gives no rows; kept columns come
back unchanged, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lotwise.llm.base import query, table
from lotwise.llm.decontamination import _pieces, text_of

TRAIN_DOCS, TRAIN_LINES = 4000, 400
PIECE = 1 << 20  # bytes of texts whose lines are described at a time, one text at least
QUANTILES = (0.01, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.87, 0.91, 0.94, 0.96, 0.98, 0.99)
BINS = len(QUANTILES) + 1
STEPS, RATE, DECAY = 150, 0.1, 1e-3
GOOD = 0.7
KINDS = 7  # lower, upper, digit, blank, sentence marks, other marks, beyond ASCII


def _kinds() -> np.ndarray:
    out = np.full(256, 5, dtype=np.uint8)
    out[97:123], out[65:91], out[48:58], out[128:] = 0, 1, 2, 6
    out[[32, 9, 10, 11, 12, 13]] = 3
    out[[ord(c) for c in ".,;:?'\"()-"]] = 4
    return out


KIND_OF = _kinds()
FEATURES = KINDS + 5


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines, FEATURES), length of each line, number of lines of each text."""
    whole = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(whole == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    lines_of = np.fromiter((t.count(b"\n") + 1 for t in texts), np.int64, len(texts))
    kind = KIND_OF[whole]
    out = np.zeros((len(starts), FEATURES), dtype=np.float32)
    size = np.maximum(length, 1)
    for k in range(KINDS):
        out[:, k] = (np.add.reduceat(kind == k, starts, dtype=np.int64) - (k == 3)) / size  # without the line's own end
    again = np.concatenate([[False], whole[1:] == whole[:-1]])
    out[:, KINDS] = np.add.reduceat(again, starts, dtype=np.int64) / size
    out[:, KINDS + 1] = np.log1p(length)
    raw = whole.tobytes()
    words = [raw[a:z].split() for a, z in zip(starts.tolist(), ends.tolist())]
    count = np.fromiter(map(len, words), np.int64, len(words))
    out[:, KINDS + 2] = np.fromiter((len(set(w)) for w in words), np.int64, len(words)) / np.maximum(count, 1)
    out[:, KINDS + 3] = length / np.maximum(count, 1)
    out[:, KINDS + 4] = np.log1p(count)
    return out, length, lines_of


def _tables(lines_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of texts by falling number of lines, first line of each, and how many have more than t lines."""
    order = np.argsort(-lines_of, kind="stable")
    first = np.cumsum(lines_of) - lines_of
    return order, first, np.searchsorted(-lines_of[order], -np.arange(lines_of.max(initial=0)), side="left")


def _chain(unary: np.ndarray, lines_of: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages as log odds of good; t[s, s'] scores state s followed by s'."""
    order, first, alive = _tables(lines_of)
    forward, backward = unary.copy(), np.zeros_like(unary)
    for i in range(1, len(alive)):
        at = first[order[:alive[i]]] + i
        r = forward[at - 1]
        forward[at] += np.logaddexp(r + t[1, 1], t[0, 1]) - np.logaddexp(r + t[1, 0], t[0, 0])
    for i in range(len(alive) - 2, -1, -1):
        at = first[order[:alive[i + 1]]] + i
        x = unary[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(t[1, 1] + x, t[1, 0]) - np.logaddexp(t[0, 1] + x, t[0, 0])
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class LineField:
    def __init__(self):
        self.edges = np.zeros((FEATURES, BINS - 1))
        self.weights = np.zeros((3, FEATURES, BINS + 1))  # of the line itself, the one before, the one after; last bin: no such line
        self.pairs = np.zeros((2, 2))
        self.curve = (1.0, 0.0)
        self.trained = False

    def bins(self, features: np.ndarray, lines_of: np.ndarray) -> np.ndarray:
        """(3, lines, FEATURES): bin numbers of the line and its neighbours."""
        own = np.stack([np.searchsorted(self.edges[k], features[:, k]).astype(np.int8) for k in range(FEATURES)], axis=1)
        first = np.cumsum(lines_of) - lines_of
        before, after = np.full_like(own, BINS), np.full_like(own, BINS)
        before[1:], after[:-1] = own[:-1], own[1:]
        before[first], after[first + lines_of - 1] = BINS, BINS
        return np.stack([own, before, after])

    def unary(self, bins: np.ndarray) -> np.ndarray:
        k = np.arange(FEATURES)
        return sum(self.weights[i][k, bins[i]].sum(axis=1) for i in range(3))

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """The length-weighted mean probability of good of each text's lines, through the curve."""
        if not self.trained:
            return np.full(len(texts), 0.5)
        features, length, lines_of = line_features(texts)
        forward, backward = _chain(self.unary(self.bins(features, lines_of)), lines_of, self.pairs)
        return _sigmoid(self.curve[0] * self.mean(_sigmoid(forward + backward), length, lines_of) + self.curve[1])

    @staticmethod
    def mean(good: np.ndarray, length: np.ndarray, lines_of: np.ndarray) -> np.ndarray:
        start = np.cumsum(lines_of) - lines_of
        return np.add.reduceat(good * (length + 1), start) / np.add.reduceat(length + 1.0, start)

    def fit(self, features: np.ndarray, length: np.ndarray, lines_of: np.ndarray, labels: np.ndarray):
        if not len(labels):
            return
        self.trained = True
        self.edges = np.quantile(features, QUANTILES, axis=0).T
        bins = self.bins(features, lines_of)
        y = np.repeat(labels, lines_of)
        first = np.cumsum(lines_of) - lines_of
        follows = np.ones(len(y), dtype=bool)
        follows[first] = False
        at = np.flatnonzero(follows)
        code = bins + (np.arange(3)[:, None, None] * FEATURES + np.arange(FEATURES)) * (BINS + 1)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[at - 1], y[at]), 1)
        value = np.concatenate([self.weights.ravel(), self.pairs.ravel()])
        moment, square = np.zeros_like(value), np.zeros_like(value)
        for step in range(1, STEPS + 1):
            self.weights, self.pairs = value[:-4].reshape(self.weights.shape), value[-4:].reshape(2, 2)
            u = self.unary(bins)
            f, b = _chain(u, lines_of, self.pairs)
            miss = y - _sigmoid(f + b)
            grad = np.bincount(code.ravel(), weights=np.broadcast_to(miss[None, :, None], code.shape).ravel(), minlength=len(value) - 4)
            x = u[at] + b[at]
            four = np.stack([self.pairs[0, 0] + 0 * x, self.pairs[0, 1] + x, f[at - 1] + self.pairs[1, 0], f[at - 1] + self.pairs[1, 1] + x])
            four = np.exp(four - four.max(axis=0))
            expected = (four / four.sum(axis=0)).sum(axis=1).reshape(2, 2)
            grad = np.concatenate([grad, (seen - expected).ravel()]) / len(y) - DECAY * value
            moment, square = 0.9 * moment + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
            value = value + RATE * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        self.weights, self.pairs = value[:-4].reshape(self.weights.shape), value[-4:].reshape(2, 2)
        f, b = _chain(self.unary(bins), lines_of, self.pairs)
        self._fit_curve(self.mean(_sigmoid(f + b), length, lines_of), labels)

    def _fit_curve(self, x: np.ndarray, y: np.ndarray):
        """Logistic regression on one number by Newton steps, with a small pull to zero; classes count alike."""
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
        a, rows = np.zeros(2), np.stack([x, np.ones_like(x)], axis=1)
        for _ in range(50):
            p = _sigmoid(rows @ a)
            grad = rows.T @ (weight * (y - p)) - 1e-3 * a
            hess = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(2)
            a = a + np.linalg.solve(hess, grad)
        self.curve = (float(a[0]), float(a[1]))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
        for part in _pieces(texts, PIECE):
            features, length, lines_of = line_features(texts[part])
            ends = np.cumsum(lines_of)
            yield pa.RecordBatch.from_arrays(
                [b.column(0)[part.start:part.stop], pa.array([features[e - n:e].tobytes() for e, n in zip(ends, lines_of)], pa.binary()),
                 pa.array([length[e - n:e].astype("<i8").tobytes() for e, n in zip(ends, lines_of)], pa.binary())], names=["quality", "features", "lengths"])


def learn(docs: DataFrame, labels: DataFrame) -> LineField:
    """docs (doc_id, text), labels (doc_id, quality) -> the field learned from the rows that aren't held out."""
    marks = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality")))
    few_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) < TRAIN_LINES
    short = docs.where(few_lines).select("doc_id")
    chosen = (marks.join(short, "doc_id", "left_semi").select("doc_id", "quality", F.xxhash64("doc_id").alias("h"))
              .orderBy("h", "doc_id").limit(TRAIN_DOCS).select("doc_id", "quality"))
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(few_lines)
            .select("quality", "text").mapInArrow(_line_rows, "quality int, features binary, lengths binary")
            .orderBy("features", "quality").limit(TRAIN_DOCS).collect())
    field = LineField()
    if rows:
        features = np.frombuffer(b"".join(bytes(r.features) for r in rows), dtype=np.float32).reshape(-1, FEATURES)
        length = np.frombuffer(b"".join(bytes(r.lengths) for r in rows), dtype="<i8")
        field.fit(features.astype(np.float64), length, np.array([len(r.lengths) // 8 for r in rows]), np.array([r.quality for r in rows]))
    return field


def _scored(field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in text_of(b).cast(pa.binary()).to_pylist()]
            scores = [field.value.documents(texts[part]) for part in _pieces(texts, PIECE)]
            keep = [j for j, c in enumerate(b.schema.names) if c != "_text"]
            yield pa.RecordBatch.from_arrays([b.column(j) for j in keep] + [pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                             names=[b.schema.names[j] for j in keep] + ["score"])
    return run


def scored(docs: DataFrame, field: LineField, keep: list[str]) -> DataFrame:
    """The kept columns with score (0 to 1) and predicted (1: good)."""
    keep = [c for c in keep if c not in ("score", "predicted", "_text")]
    rows = docs.select(*keep, *([] if keep == ["_row"] else [F.col("text").alias("_text")]))
    types = StructType([*rows.drop("_text").schema.fields, StructField("score", DoubleType())])
    out = rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(field)), types)
    return out.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def filter_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that are predicted bad, all columns unchanged; all of them if no label could be learned from."""
    field = learn(docs, labels)
    if not field.trained:
        return docs
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return scored(docs.select(row), field, ["_row"]).where("predicted = 1").select("_row.*")


@query("op9_quality")
def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = scored(docs, learn(docs, labels), ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
