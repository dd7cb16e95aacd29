"""Quality classifier by positive-unlabelled learning.

A small network is trained on trusted positives and unlabelled web text.  It minimises the
non-negative unbiased risk: the risk of negatives, which nobody labelled, is that of the unlabelled
texts less the share of the positives among them, and it is never allowed below zero.  The share of
positives (the class prior) is estimated from a part of both sets that the network did not see.

The inputs are shapes of the text alone (kinds of characters, repetition, lengths), so the model does
not depend on a language's vocabulary.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from .common import fresh, id_remainder, small_batches, table, text_bytes

#: Most trusted positives, and most unlabelled texts, that the classifier is fitted on.
MOST_FIT_ROWS = 12_000
ACCEPT = 0.3
HELD_OUT_PARTS = 5
SCORE_WITHOUT_MODEL = 0.5

_LOWER = bytes(range(97, 123))
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SPACES = b" \t\n\r\x0b\x0c"
_PROSE_MARKS = b".,;:'\"()-?"
_SYMBOLS = bytes(
    c for c in range(33, 127) if c not in _LOWER + _UPPER + _DIGITS + _PROSE_MARKS
)
_WIDE = bytes(range(128, 256))
N_FEATURES = 20


def features(text: bytes) -> list[float]:
    """Shape of a text, bounded numbers; an empty text has zeros and a first one."""
    size = len(text)
    if not size:
        return [1.0] + [0.0] * (N_FEATURES - 1)

    def share(kind: bytes) -> float:
        return 1 - len(text.translate(None, kind)) / size

    words = text.split()
    n = len(words) or 1
    kinds = set(words)
    lines = text.split(b"\n")
    filled = [line for line in lines if line.strip()]
    ends = sum(map(text.count, (b". ", b".\n", b"? ", b"! ")))
    same_next = sum(map(bytes.__eq__, words, words[1:]))
    lengths = np.fromiter(map(len, words), np.int32, len(words)) if words else np.zeros(1, np.int32)
    marked = len(text.translate(None, bytes(set(range(256)) - set(_SYMBOLS))))
    return [
        0.0,
        share(_LOWER),
        share(_UPPER),
        share(_DIGITS),
        share(_SPACES),
        share(_PROSE_MARKS),
        share(_SYMBOLS),
        share(_WIDE),
        text.count(b"|") / n,
        min(2.0, text.count(b"!") / n),
        min(2.0, marked / n),
        min(3.0, float(lengths.mean()) / 10),
        min(3.0, float(lengths.std()) / 10),
        min(3.0, float(lengths.max()) / 30),
        len(kinds) / n / (1 + np.log1p(n) / 10),
        same_next / n,
        1 - len(set(filled)) / max(1, len(filled)),
        min(1.5, ends / n * 5),
        np.log1p(n) / 10,
        np.log1p(n / max(1, len(filled))) / 8,
    ]


def feature_rows(texts: pa.Array) -> np.ndarray:
    rows = [features(text) for text in text_bytes(texts)]
    return np.array(rows, np.float32).reshape(len(rows), N_FEATURES)


@dataclass(frozen=True)
class Model:
    """A network with one hidden layer, and how its inputs are scaled."""

    mean: np.ndarray
    spread: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.tanh(x @ self.hidden + self.hidden_bias) @ self.out + self.out_bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores the network gave to texts it did not see.

    Above any threshold the unlabelled hold at least the prior's share of the positives found there;
    the smallest quotient of both tails, with a margin for chance, is the estimate.
    """
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.unique(positive)
    tail_p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    tail_u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    slack = np.sqrt(np.log(4 / confidence) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    best = np.argmin((tail_u + slack) / np.maximum(tail_p, 1e-9))
    return float(np.clip(tail_u[best] / max(tail_p[best], 1e-9), 0.05, 0.95))


def _train(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int,
    width: int = 24, epochs: int = 60, batch: int = 512, rate: float = 0.01, decay: float = 1e-4,
) -> Model:
    """Adam on mini-batches of the non-negative risk under logistic loss."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    mean, spread = both.mean(0), both.std(0) + 1e-3
    p_all, u_all = (np.clip((x - mean) / spread, -6, 6) for x in (positive, unlabelled))
    weights = [
        rng.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, width)),
        np.zeros(width),
        rng.normal(0, 1 / np.sqrt(width), width),
        np.zeros(1),
    ]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    rounds = max(1, -(-max(len(p_all), len(u_all)) // batch))
    for _ in range(max(epochs, 600 // rounds)):
        p_order, u_order = rng.permutation(len(p_all)), rng.permutation(len(u_all))
        for k in range(rounds):
            p = p_all[np.take(p_order, np.arange(k * batch, (k + 1) * batch), mode="wrap")]
            u = u_all[np.take(u_order, np.arange(k * batch, (k + 1) * batch), mode="wrap")]
            x = np.concatenate([p, u])
            h = np.tanh(x @ weights[0] + weights[1])
            z = h @ weights[2] + weights[3]
            s = _sigmoid(z)
            zp, zu = z[: len(p)], z[len(p) :]
            negatives = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            # Gradients of the three mean losses with respect to the margins.
            dz = np.empty_like(z)
            if negatives >= 0:
                dz[: len(p)] = prior * ((s[: len(p)] - 1) - s[: len(p)]) / len(p)
                dz[len(p) :] = s[len(p) :] / len(u)
            else:  # push the negative part of the risk back up
                dz[: len(p)] = prior * s[: len(p)] / len(p)
                dz[len(p) :] = -s[len(p) :] / len(u)
            dh = np.outer(dz, weights[2]) * (1 - h * h)
            grads = [
                x.T @ dh + decay * weights[0], dh.sum(0),
                h.T @ dz + decay * weights[2], dz.sum(keepdims=True),
            ]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                scale = np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
                weights[i] = weights[i] - rate * first[i] / (1 - 0.9**step) / scale
    return Model(mean, spread, weights[0], weights[1], weights[2], float(weights[3][0]), prior)


def train(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 7) -> Model:
    """Estimate the class prior on a split, then fit on everything with it.

    The prior is estimated twice: with the scores of a first network that takes half of the
    unlabelled as positive, then with those of one that takes the first estimate.
    """
    rng = np.random.default_rng(seed)
    p, u = positive[rng.permutation(len(positive))], unlabelled[rng.permutation(len(unlabelled))]
    p_cut, u_cut = max(1, len(p) * 2 // 3), max(1, len(u) * 2 // 3)
    prior = 0.5
    for _ in range(2):
        if p_cut < len(p) and u_cut < len(u):
            probe = _train(p[:p_cut], u[:u_cut], prior, seed, epochs=20)
            prior = estimate_prior(probe.margin(p[p_cut:]), probe.margin(u[u_cut:]))
    return _train(p, u, prior, seed)


def fit(
    documents: DataFrame,
    positives: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unlabelled: Column | None = None,
    most_rows: int = MOST_FIT_ROWS,
    seed: int = 7,
) -> Model | None:
    """Fit on at most ``most_rows`` of the ``positives`` (ids) and as many unlabelled documents.

    Both samples are those of the smallest hashes of the id, so reruns agree.  Documents with a NULL id
    are scored, not fitted on.  Without any positive or any document there is no model: None.
    """

    def chosen(ids: DataFrame, kind: int) -> DataFrame:
        ids = ids.where(F.col(id_col).isNotNull()).select(id_col).distinct()
        return ids.orderBy(F.xxhash64(id_col), id_col).limit(most_rows).withColumn("_kind", F.lit(kind))

    texts = documents.select(id_col, text_col)
    web = documents if unlabelled is None else documents.where(unlabelled)
    sample = chosen(positives, 1).unionByName(chosen(web, 0))
    # At most twice ``most_rows`` ids, a bound that does not grow.
    picked = texts.join(F.broadcast(sample), id_col).select("_kind", text_col)
    rows = picked.mapInArrow(_features_of, "kind int, x array<float>").toPandas()
    kinds = rows["kind"].to_numpy()
    x = np.array(rows["x"].tolist(), np.float32).reshape(len(rows), N_FEATURES)
    # The order in which rows arrive is not fixed.
    order = np.lexsort([*x.T, kinds])
    kinds, x = kinds[order], x[order]
    if not (kinds == 1).any() or not (kinds == 0).any():
        return None
    return train(x[kinds == 1], x[kinds == 0], seed)


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = feature_rows(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int32()), pa.array(list(x), pa.list_(pa.float32()))], ["kind", "x"]
        )


def score(model: Model | None, text: Column) -> Column:
    """Probability that a text is good; NULL counts as empty.  Without a model, one half."""
    if model is None:
        return F.lit(SCORE_WITHOUT_MODEL)

    @arrow_udf(T.DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.score(feature_rows(texts)).astype(np.float64))

    return scored(text)


def trusted(labels: DataFrame) -> DataFrame:
    """Ids that may be learnt from and are labelled good."""
    return labels.where((F.col("quality") == 1) & (id_remainder(F.col("doc_id"), HELD_OUT_PARTS) != 0))


def fit_on_tables(documents: DataFrame, labels: DataFrame) -> Model | None:
    return fit(
        documents,
        trusted(labels),
        unlabelled=id_remainder(F.col("doc_id"), HELD_OUT_PARTS) != 0,
    )


def keep_good(documents: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """The documents with a score of at least ``accept``, all their columns as they are."""
    small_batches(documents.sparkSession)
    model = fit_on_tables(documents, labels)
    column = fresh(documents, "quality_score")
    scored = documents.withColumn(column, score(model, F.col("text")))
    return scored.where(F.col(column) >= accept).drop(column)


def score_quality(spark, sf_dir) -> DataFrame:
    """One row per document: doc_id, held_out (false for a NULL id), score, predicted."""
    small_batches(spark)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_on_tables(documents, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(id_remainder(F.col("doc_id"), HELD_OUT_PARTS) == 0, F.lit(False))
    return documents.select(
        "doc_id", held_out.alias("held_out"), score(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
