r"""Quality classifier: ordinal cumulative-link regression on hashed words.

P(grade <= k) = sigmoid(threshold_k - score), one score shared by all grades:
the sum of the hashed weights of a text's words and word endings, over the
square root of the number of words. Ordered thresholds turn the score into
the expected grade and the tail probability P(grade >= k) used to select.

Grades of the given labels (``grade_of``): 0 toxic, 1 low quality, 2 good.

The fit uses at most ``sample_rows`` labelled documents, those of least hashed
id (a documented bound, so the sample may be broadcast and its features
collected); scoring reads every whole text, in Arrow batches, with a weight
table of fixed size.

Edge cases: a null, empty or blank text has score 0. A null label, or a null
id, is no training row; a document with several label rows counts with each.
Without any label all weights are 0 and every document is kept. Rows of equal
id are scored each by its own text. Extra columns are carried; a result column
replaces one of the same name. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.textbytes import SpanHash, flat, lower_ascii, pieces, words

#: Size of the weight table (a power of two), bytes of text handled at once, and the bound of the sample.
DIMENSIONS, STEP_BYTES, SAMPLE_ROWS = 1 << 18, 2 << 20, 16384
GOOD = 2


def grade_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, 0).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 2)


def features(texts: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all texts (two a word: the word, its last two bytes), and each text's bounds."""
    data, offsets = flat(texts)
    start, end, bounds = words(data, offsets)
    whole = SpanHash(lower_ascii(data))(start, end)
    ending = SpanHash(data)(np.maximum(start, end - 2), end) + np.uint64(1)
    h = np.stack([whole, ending * np.uint64(0x9E3779B97F4A7C15)], axis=1).reshape(-1)
    return ((h >> np.uint64(32)) & np.uint64(dimensions - 1)).astype(np.int64), 2 * bounds


def scores(weights: np.ndarray, index: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(weights[index], dtype=np.float64)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]) / np.sqrt(np.maximum(1, np.diff(bounds) // 2))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class OrdinalModel:
    weights: np.ndarray      # float32, DIMENSIONS
    thresholds: np.ndarray   # ascending, one less than grades

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. (rows: documents)."""
        return sigmoid(score[:, None] - self.thresholds[None, :])


def distinct(index: np.ndarray, bounds: np.ndarray, dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct features (int32), how often it has each (float32), and the new bounds."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pairs, count = np.unique(doc * dimensions + index, return_counts=True)
    return ((pairs % dimensions).astype(np.int32), count.astype(np.float32),
            np.searchsorted(pairs, np.arange(len(bounds)) * dimensions))


def fit_features(index: np.ndarray, bounds: np.ndarray, grade: np.ndarray, dimensions: int = DIMENSIONS, **how) -> OrdinalModel:
    """The model of whole feature lists (see ``features``) and their grades."""
    return fit_distinct(*distinct(index, bounds, dimensions), np.diff(bounds) // 2, grade, dimensions=dimensions, **how)


def fit_distinct(index: np.ndarray, count: np.ndarray, bounds: np.ndarray, n_words: np.ndarray, grade: np.ndarray,
                 grades: int = GOOD + 1, dimensions: int = DIMENSIONS, rounds: int = 60, rate: float = 0.1, l2: float = 1.0,
                 least_docs: int = 8) -> OrdinalModel:
    """Maximum likelihood by Adam on the whole sample, deterministic; classes weigh alike.

    Features of fewer than ``least_docs`` sample documents keep weight 0: they
    would only be learned by heart.
    """
    cuts = np.linspace(-1.0, 1.0, grades - 1) - 1.0
    n = len(grade)
    if not n:
        return OrdinalModel(np.zeros(dimensions, np.float32), cuts - 1.0)
    first, steps = cuts[0], np.log(np.maximum(np.diff(cuts), 1e-3))
    in_docs = np.bincount(index, minlength=dimensions)
    used = in_docs[index] >= least_docs
    frequent = np.flatnonzero(in_docs >= least_docs)
    number = (np.cumsum(in_docs >= least_docs) - 1).astype(np.int32)    # the frequent features, counted through
    doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds))[used]
    index, count, w = number[index[used]], count[used], np.zeros(len(frequent))
    scale = 1 / np.sqrt(np.maximum(1, n_words))
    counts = np.bincount(grade, minlength=grades)
    weight = (n / (np.count_nonzero(counts) * np.maximum(1, counts)))[grade] / n
    m, v = np.zeros(len(w) + grades - 1), np.zeros(len(w) + grades - 1)
    for t in range(1, rounds + 1):
        cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
        s = np.bincount(doc, weights=w[index] * count, minlength=n) * scale
        upper = np.where(grade < grades - 1, sigmoid(cuts[np.minimum(grade, grades - 2)] - s), 1.0)
        lower = np.where(grade > 0, sigmoid(cuts[np.maximum(grade - 1, 0)] - s), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p      # d log p by the two cuts
        ds = weight * (du - dl)                                        # minus d log p / d s
        dw = np.bincount(index, weights=(ds * scale)[doc] * count, minlength=len(w)) + l2 * w / n
        dc = np.zeros(grades - 1)
        np.add.at(dc, np.minimum(grade, grades - 2), -weight * du)
        np.add.at(dc, np.maximum(grade - 1, 0), weight * dl)
        later = np.cumsum(dc[::-1])[::-1]
        g = np.concatenate([dw, [later[0]], later[1:] * np.exp(steps)])
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w -= step[: len(w)]
        first -= step[len(w)]
        steps = steps - step[len(w) + 1 :]
    cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
    whole = np.zeros(dimensions, np.float32)
    whole[frequent] = w
    return OrdinalModel(whole, cuts)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, dimensions: int = DIMENSIONS) -> OrdinalModel:
    """The model of at most ``sample_rows`` labelled documents (doc_id, text) with labels (doc_id, grade): those of least hashed id."""
    labelled = labels.filter("doc_id IS NOT NULL AND grade IS NOT NULL").select("doc_id", "grade")
    total = labelled.count()
    # hashes are spread evenly: below this bound there are a few more than asked for, so few rows are put in order
    share = (sample_rows + 8 * sample_rows**0.5 + 64) / max(1, total)
    few = labelled.filter(F.xxhash64("doc_id") < int(share * 2**64) - 2**63) if share < 1 else labelled
    chosen = few.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "grade", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", STEP_BYTES):
            every, whole = features(b.column("text"), dimensions)
            index, count, bounds = distinct(every, whole, dimensions)
            cut = list(zip(bounds.tolist(), bounds[1:].tolist()))
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id").cast(pa.int64()), "grade": b.column("grade").cast(pa.int32()),
                "n_words": pa.array(np.diff(whole) // 2, pa.int64()),
                "index": pa.array([index[x:y].tobytes() for x, y in cut], pa.binary()),
                "count": pa.array([count[x:y].tobytes() for x, y in cut], pa.binary())})

    rows = sample.mapInArrow(hashed, "doc_id bigint, grade int, n_words bigint, index binary, count binary").toArrow()
    # in one order whatever the tasks' order; equal rows may change places
    rows = rows.sort_by([("doc_id", "ascending"), ("grade", "ascending"), ("n_words", "ascending")])

    def joined(column: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(rows.column(column).to_pylist()), kind)

    bounds = np.concatenate([[0], np.cumsum([len(x) // 4 for x in rows.column("index").to_pylist()])]).astype(np.int64)
    return fit_distinct(joined("index", np.int32), joined("count", np.float32), bounds, rows.column("n_words").to_numpy(),
                        rows.column("grade").to_numpy(), dimensions=dimensions)


def with_grades(docs: DataFrame, model: OrdinalModel, least_good: float = 0.3) -> DataFrame:
    """``docs`` plus score, expected_grade, p_not_toxic, p_good and ``kept`` (p_good >= least_good)."""
    added = [("score", "double"), ("expected_grade", "double"), ("p_not_toxic", "double"), ("p_good", "double"),
             ("kept", "boolean")]
    names = {n for n, _ in added}
    rest = docs.drop(*[c for c in docs.columns if c in names])
    schema = T.StructType(rest.schema.fields + [T.StructField(n, T._parse_datatype_string(t)) for n, t in added])
    dimensions = len(model.weights)

    def graded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", STEP_BYTES):
            s = scores(model.weights, *features(b.column("text"), dimensions))
            tails = model.tails(s)
            values = [s, tails.sum(axis=1), tails[:, 0], tails[:, -1], tails[:, -1] >= least_good]
            for (n, _), x in zip(added, values):
                b = b.append_column(n, pa.array(x))
            yield b

    return rest.mapInArrow(graded, schema)
