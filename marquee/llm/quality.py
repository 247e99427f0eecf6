"""Quality classifier: random-indexing word vectors and a small neural network.

1. Word vectors. Every word has two ids, one of its letters and one of its
   shape (capitals, letters, digits, runs collapsed, other characters as they
   are), hashed into fixed tables, so memory does not depend on the
   vocabulary. Every id has a sparse random index vector; the vector of an id
   is the sum of the index vectors of its neighbours over the whole corpus
   (random indexing, Kanerva 2000). The sums are whole numbers: partial sums
   of the partitions add up to the same vectors in any order.
2. Pooling. A document is the mean and the spread of its words' vectors, the
   length of the mean, the share of distinct ids and the mean inner product of
   neighbouring words (loops of a few words have a long mean, few ids and like
   neighbours), and the log of its length.
3. A two-layer network is fitted with numpy on the driver to a bounded sample
   of labelled rows (``MAX_ROWS``), part of which is kept back to fit the
   temperature that calibrates its probabilities.

Edge cases: NULL or empty text pools to zeros and is scored like any other;
NULL labels are not used; of a document's repeated labels the larger counts;
without labelled rows of both classes every score is the share of label 1
(0.5 without any); an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ship_package, stage
from marquee.llm.tokens import _Generations

WORD_IDS = 1 << 14
SHAPE_IDS = 1 << 11
IDS = WORD_IDS + SHAPE_IDS
DIMENSIONS = 32
NONZEROS = 2
BLOCKS = 32
FEATURES = 4 * DIMENSIONS + 7
MAX_ROWS = 20_000
HIDDEN = 32
SEED = 20_260
_WORDS_AT_ONCE = 400_000
_ROWS_AT_ONCE = 1000
THRESHOLD = 0.3

_rng = np.random.RandomState(SEED)
#: index vectors: positions and signs of the nonzero components of each id
_POSITIONS = _rng.randint(0, DIMENSIONS, (NONZEROS, IDS)).astype(np.int32)
_SIGNS = _rng.choice(np.array([-1, 1], np.int32), (NONZEROS, IDS))


def _shape(text: str) -> str:
    """Of a word's letters only, ``isalpha()``: one of three common shapes, else None."""
    if text.islower():
        return "a"
    if text.isupper():
        return "A"
    return "Aa" if text[0].isupper() and text[1:].islower() else None


def _long_shape(word: str) -> str:
    out = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def _ids(word: bytes) -> int:
    """Both ids of a word in one number."""
    text = word.decode("utf-8", "replace")
    shape = None
    if text.isalpha():
        letters, shape = text, _shape(text)
    elif text[:-1].isalpha():
        letters, shape = text[:-1], _shape(text[:-1])
        shape = shape and shape + text[-1]
    else:
        letters = "".join(filter(str.isalnum, text)) or text
    shape = shape or _long_shape(text)
    w = zlib.crc32(letters.lower().encode("utf-8", "surrogatepass")) % WORD_IDS
    s = WORD_IDS + zlib.crc32(shape.encode("utf-8", "surrogatepass")) % SHAPE_IDS
    return s << 32 | w


_words = _Generations(_ids, 200_000)


def word_ids(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Letter ids and shape ids of a text's words."""
    words = text.encode("utf-8", "surrogatepass").split()
    _words.trim()
    both = np.fromiter(map(_words.__getitem__, words), np.int64, len(words))
    return both & 0xFFFFFFFF, both >> 32


def _neighbour_sums(texts: list[np.ndarray]) -> np.ndarray:
    """Sums of the index vectors of both neighbours of every id."""
    ids = np.concatenate(texts)
    inside = np.ones(max(len(ids) - 1, 0), bool)
    ends = np.cumsum([len(t) for t in texts])[:-1]
    inside[ends[(ends > 0) & (ends < len(ids))] - 1] = False  # no pairs across texts
    left, right = ids[:-1][inside], ids[1:][inside]
    sums = np.zeros(IDS * DIMENSIONS)
    for a, b in ((left, right), (right, left)):
        for k in range(NONZEROS):
            sums += np.bincount(a * DIMENSIONS + _POSITIONS[k][b], _SIGNS[k][b], IDS * DIMENSIONS)
    return sums.astype(np.int64)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """(IDS, DIMENSIONS) unit vectors from the neighbours of all words of all
    documents; a few MB, whatever the corpus."""
    ship_package(docs.sparkSession)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(IDS * DIMENSIONS, np.int64)
        texts, held = [], 0
        for batch in batches:
            for value in batch.column(0):
                for ids in word_ids(value.as_py()):
                    texts.append(ids)
                    held += len(ids)
                if held > _WORDS_AT_ONCE:
                    sums += _neighbour_sums(texts)
                    texts, held = [], 0
        if texts:
            sums += _neighbour_sums(texts)
        for block, part in enumerate(np.split(sums, BLOCKS)):
            if part.any():
                yield pa.record_batch({"block": pa.array([block]), "sums": pa.array([part.tobytes()], pa.binary())})

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(part.as_buffer(), np.int64)
                sums[block] = sums[block] + part if block in sums else part
        for block, part in sums.items():
            yield pa.record_batch({"block": pa.array([block]), "sums": pa.array([part.tobytes()], pa.binary())})

    parts = docs.select(text).where(F.col(text).isNotNull()).mapInArrow(partial, "block long, sums binary")
    rows = parts.repartition(BLOCKS, "block").mapInArrow(total, "block long, sums binary").collect()
    sums = np.zeros((BLOCKS, IDS * DIMENSIONS // BLOCKS), np.float64)
    for r in rows:
        sums[r["block"]] += np.frombuffer(r["sums"], np.int64)
    vectors = sums.reshape(IDS, DIMENSIONS)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(norms, 1)).astype(np.float32)


def pool(text: str, vectors: np.ndarray) -> np.ndarray:
    out = np.zeros(FEATURES, np.float32)
    words, shapes = word_ids(text)
    n = len(words)
    if n:
        at = 0
        for ids in (words, shapes):
            v = vectors[ids]
            mean = v.mean(axis=0)
            out[at : at + DIMENSIONS] = mean
            out[at + DIMENSIONS : at + 2 * DIMENSIONS] = np.sqrt(np.maximum((v * v).mean(axis=0) - mean * mean, 0))
            out[at + 2 * DIMENSIONS] = np.linalg.norm(mean)
            out[at + 2 * DIMENSIONS + 1] = len(np.unique(ids)) / n
            if n > 1:  # likeness of neighbours
                out[at + 2 * DIMENSIONS + 2] = np.einsum("ij,ij->", v[:-1], v[1:]) / (n - 1)
            at += 2 * DIMENSIONS + 3
        out[at] = np.log1p(n)
    return out


class Network:
    """Inputs are standardised; one hidden layer; a logit over a temperature."""

    def __init__(self, prior: float = 0.5) -> None:
        self.prior, self.layers = prior, None

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 4000, batch: int = 128, rate: float = 3e-3) -> Network:
        rng = np.random.RandomState(SEED)
        self.prior = float(y.mean()) if len(y) else 0.5
        if len(y) < 20 or y.min() == y.max():
            return self
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x = self._scaled(x)
        order = rng.permutation(len(y))
        back, fitted = order[: max(10, len(y) // 8)], order[max(10, len(y) // 8) :]
        p = [
            rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
            rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1),
        ]
        m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
        step = 0
        for _ in range(-(-steps * batch // len(fitted))):
            rng.shuffle(fitted)
            for at in range(0, len(fitted), batch):
                rows = fitted[at : at + batch]
                h = np.maximum(x[rows] @ p[0] + p[1], 0)
                miss = (_sigmoid(h @ p[2] + p[3]) - y[rows]) / len(rows)
                dh = np.outer(miss, p[2]) * (h > 0)
                g = [x[rows].T @ dh + 1e-4 * p[0], dh.sum(0), h.T @ miss + 1e-4 * p[2], np.array([miss.sum()])]
                step += 1
                for i in range(4):  # Adam
                    m[i] += 0.1 * (g[i] - m[i])
                    v[i] += 0.001 * (g[i] ** 2 - v[i])
                    p[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.layers = p
        logit = self._logit(x[back])
        losses = {
            t: -np.log(np.where(y[back] == 1, _sigmoid(logit / t), 1 - _sigmoid(logit / t)) + 1e-12).mean()
            for t in np.geomspace(0.5, 8, 49)
        }
        self.temperature = min(losses, key=losses.get)
        return self

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.maximum(x @ a + b, 0) @ c + d

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.prior)
        return _sigmoid(self._logit(self._scaled(x.astype(np.float64))) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(key: str):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fitted(
    docs: DataFrame, labels: DataFrame, vectors: np.ndarray, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS
) -> Network:
    """A network fitted to at most ``max_rows`` labelled documents that are
    not held out, in the order of a hash of their key."""
    usable = (
        labels.select(F.col(key).cast("long").alias("key"), F.col(label).cast("int").alias("label"))
        .where(~held_out("key") & F.col("label").isin(0, 1) & F.col("key").isNotNull())
        .groupBy("key").agg(F.max("label").alias("label"))
        .join(docs.select(F.col(key).cast("long").alias("key")), "key", "left_semi")
        .orderBy(F.xxhash64("key"), "key").limit(max_rows)
    )
    usable = stage(usable, "quality-sample")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pool(v.as_py(), shared.value).tobytes() for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(rows, pa.binary())], names=["key", "label", "features"])

    texts = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(usable), "key").select("key", "label", "text")  # at most max_rows keys
    sample = sample.mapInArrow(run, "key long, label int, features binary")
    sample = sample.groupBy("key").agg(F.min("features").alias("features"), F.first("label").alias("label"))
    rows = sorted(sample.collect(), key=lambda r: r["key"])
    x = np.array([np.frombuffer(r["features"], np.float32) for r in rows], np.float64).reshape(len(rows), FEATURES)
    return Network().fit(x, np.array([r["label"] for r in rows], float))


def _scores(shared, texts: pa.Array) -> np.ndarray:
    network, vectors = shared.value
    if not len(texts):
        return np.zeros(0)
    return network.score(np.array([pool(v.as_py() or "", vectors) for v in texts]))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: key, held_out, score (probability of label 1),
    predicted. Labels of held-out rows are never read by the fit."""
    ship_package(docs.sparkSession)
    vectors = word_vectors(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast((fitted(docs, labels, vectors, key, text), vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(shared, batch.column(1)))], names=["key", "score"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key long, score double").select(
        F.col("key").alias(key), held_out("key").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, network: Network, vectors: np.ndarray, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((network, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(at, _ROWS_AT_ONCE)
                yield part.filter(pa.array(_scores(shared, part.column(text)) >= threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
