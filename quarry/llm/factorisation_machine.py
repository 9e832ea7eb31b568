"""Quality classifier: a factorisation machine over text features.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where the
pairwise term is computed in linear time as half of the squared sum minus the
sum of squares.  Features are hashed words (share of the text, square root),
structure statistics as bins, and the length recorded in ``n_chars`` as a bin
of metadata.  Labels, language, source and id are never inputs of a score.

At most ``MAX_LABELLED`` labelled rows (a documented bound, taken in hash order
of the id) fit the model on the driver; every document is scored in tasks.

Edge cases: NULL and empty texts have structure features only and get a score;
NULL ``n_chars`` has a bin of its own; rows with a NULL label, or an id that is
NULL, do not train; a document labelled twice takes the smaller label; without
both classes every score is the share of label 1 (0.5 without labels); repeated
rows are scored one by one; extra columns stay in :func:`score`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.textblocks import _IS_SPACE, blocks, words

MAX_LABELLED = 6000
BUCKETS = 1 << 12
FACTORS = 8
BINS = 8
THRESHOLD = 0.3

#: Upper edges of the bins of each structure statistic.
EDGES = {
    "log_words": (1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 7.5),
    "word_bytes": (2.5, 3.5, 4.5, 5.5, 6.5, 8.0, 12.0),
    "symbols": (0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2),
    "digits": (0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2),
    "capitals": (0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3),
    "variety": (0.2, 0.4, 0.55, 0.7, 0.8, 0.9, 0.97),
    "new_pairs": (0.3, 0.5, 0.7, 0.8, 0.9, 0.95, 0.99),
    "line_words": (2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0),
    "metadata_chars": (4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0),
}
WIDTH = BUCKETS + (BINS + 1) * len(EDGES)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>@^~_=+{}[]\\")] = True


def features(texts: pa.Array, n_chars: np.ndarray) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first, last, [(index, value)]) of blocks of documents; ``n_chars`` is NaN where NULL."""
    for first, last, raw, at in blocks(texts):
        hashes, of = words(raw, at)
        out = []
        for d in range(last - first):
            body, w = raw[at[d]:at[d + 1]], hashes[of[d]:of[d + 1]]
            n = len(w)
            index, counts = np.unique((w % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
            value = np.sqrt(counts / max(n, 1))
            solid = max(int((~_IS_SPACE[body]).sum()), 1)
            pairs = len(np.unique(w[1:] * np.uint64(31) ^ w[:-1])) / (n - 1) if n > 1 else 1.0
            chars = n_chars[first + d]
            stats = (np.log1p(n), solid / max(n, 1), _SYMBOL[body].sum() / solid,
                     ((body >= 48) & (body <= 57)).sum() / solid, ((body >= 65) & (body <= 90)).sum() / solid,
                     np.log(len(np.unique(w))) / np.log(n) if n > 1 else 1.0, pairs,
                     n / max(int((body == 10).sum()) + 1, 1), None if np.isnan(chars) else np.log1p(max(chars, 0.0)))
            bins = [BINS if s is None else int(np.searchsorted(e, s)) for s, e in zip(stats, EDGES.values())]
            place = BUCKETS + np.arange(len(bins)) * (BINS + 1) + np.array(bins)
            out.append((np.concatenate([index, place]), np.concatenate([value, np.full(len(bins), 0.3)])))
        yield first, last, out


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[index] * value[:, None]
        return float(self.bias + self.linear[index] @ value + 0.5 * (v.sum(0) ** 2 - (v ** 2).sum(0)).sum())


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 25, rate: float = 0.02,
        decay: float = 1e-4, seed: int = 7) -> Model:
    """Adam on the logistic loss, in mini-batches of dense rows."""
    model = Model(0.0, np.zeros(WIDTH), np.zeros((WIDTH, FACTORS)))
    share = labels.mean() if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        model.bias = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
        return model
    rng = np.random.default_rng(seed)
    w = np.zeros(WIDTH + 1)
    w[-1] = np.log(share / (1 - share))
    v = rng.normal(0, 0.05, (WIDTH, FACTORS))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(v), np.zeros_like(v)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 128):
            part = order[at:at + 128]
            x = np.zeros((len(part), WIDTH))
            for k, r in enumerate(part):
                x[k, rows[r][0]] += rows[r][1]
            xv, x2 = x @ v, x ** 2
            z = x @ w[:-1] + w[-1] + 0.5 * (xv ** 2 - x2 @ v ** 2).sum(1)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) / len(part)
            gw = np.concatenate([x.T @ error + decay * w[:-1], [error.sum()]])
            gv = x.T @ (error[:, None] * xv) - v * (x2.T @ error)[:, None] + decay * v
            step += 1
            for p, g, m, s in ((w, gw, state[0], state[1]), (v, gv, state[2], state[3])):
                m += 0.1 * (g - m)
                s += 0.001 * (g ** 2 - s)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return Model(float(w[-1]), w[:-1], v)


def _with_meta(docs: DataFrame) -> Column:
    return F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        meta = np.array([np.nan if x is None else x for x in batch["_meta_of_text"].to_pylist()])
        for first, last, rows in features(batch["text"], meta):
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["quality"], pa.array([i for i, _ in rows], pa.list_(pa.int32())),
                 pa.array([x for _, x in rows], pa.list_(pa.float64()))], names=["doc_id", "quality", "i", "x"])


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, most: int = MAX_LABELLED) -> Model:
    """Fit on at most ``most`` labelled rows for which ``usable`` (over doc_id) holds.

    The chosen ids are at most ``most`` rows, so that side is broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
    known = known.where(usable) if usable is not None else known
    chosen = (known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        _with_meta(docs).alias("_meta_of_text"))
    got = (plain.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "_meta_of_text", "quality")
           .mapInArrow(_sparse, "doc_id long, quality int, i array<int>, x array<double>").dropDuplicates(["doc_id"]).toPandas())
    got = got.sort_values("doc_id", kind="stable")
    rows = [(np.asarray(i, np.int64), np.asarray(x, float)) for i, x in zip(got["i"], got["x"])]
    return fit(rows, got["quality"].to_numpy(float))


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            meta = np.array([np.nan if x is None else x for x in batch["_meta_of_text"].to_pylist()])
            for first, last, rows in features(batch["text"], meta):
                part = batch.slice(first, last - first)
                z = np.array([model.raw(i, x) for i, x in rows])
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                keep = [c for c in part.schema.names if c != "_meta_of_text"]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in keep), pa.array(score)], names=[*keep, "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1."""
    plain = docs.drop("score").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in plain.schema.fields),
                           T.StructField("score", T.DoubleType())])
    return plain.withColumn("_meta_of_text", _with_meta(docs)).mapInArrow(_score(model), schema)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels, ~held_out())
    n_chars = ["n_chars"] if "n_chars" in docs.columns else []
    return score(docs.select("doc_id", "text", *n_chars), model).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
