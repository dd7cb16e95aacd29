"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Two words are compared by the characters they share in the same order, gaps allowed: every
subsequence of three characters within a stretch of six counts with a weight that falls with its
length.  An insult with a character left out, put in or doubled keeps most of its subsequences.  The
kernel, normalised and raised to a power, is approximated by its values at some hundred landmark words
(Nyström); a sentence is the sum of its words, so the machine's decision for a sentence is the sum of
one number per word.

Labels are for documents, so the machine learns as one for multiple instances: the sentence of a toxic
document that looks worst stands for it, all sentences of clean documents are clean, and both are
chosen anew after each fit.  A document's score is that of its worst sentence, as a probability.
"""

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from .common import id_remainder, small_batches, table, text_bytes

#: Most toxic and most clean documents that the machine is fitted on.
MOST_TOXIC, MOST_CLEAN = 2_000, 4_000
ACCEPT = 0.3
HELD_OUT_PARTS, HELD_OUT = 4, 2
SCORE_WITHOUT_MODEL = 0.0

ORDER, SPAN, DECAY, POWER = 3, 6, 0.6, 4
#: Longer words are compared piece by piece; the pieces overlap by half.
LONGEST = 24
TOXIC_LANDMARKS, CLEAN_LANDMARKS = 64, 16
#: A stretch without a full stop is cut into sentences of so many words.
SENTENCE_WORDS = 40
ROUNDS = 3
#: Words whose scores a worker remembers.
MOST_KNOWN = 400_000
TEXTS_AT_A_TIME = 50

_LOOKALIKE = str.maketrans("01345@$!|7", "oieasasiit")
_LETTERS = re.compile(r"[^\W\d_]+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_ALPHABET = 64
_FIRST, _LAST = 62, 63


def units(chunk: bytes) -> list[str]:
    """The words to compare for a stretch without blanks: its letters, and its parts if it has several.

    Marks at the ends go; among letters, characters that stand for letters become them, and what is
    then no letter was put in between and goes.
    """
    core = _EDGES.sub("", chunk.decode(errors="ignore").lower())
    if sum(map(len, _LETTERS.findall(core))) > 1:
        core = core.translate(_LOOKALIKE)
    parts = _LETTERS.findall(core)
    if len(parts) > 1:
        return ["".join(parts), *(p for p in parts if len(p) > 2)]
    return parts


def _pieces(word: str) -> list[str]:
    if len(word) <= LONGEST:
        return [word]
    step = LONGEST // 2
    return [word[k : k + LONGEST] for k in range(0, len(word) - step, step)]


def _codes(words: list[str]) -> np.ndarray:
    """Characters of words of one length, with marks for both ends, as numbers below 64."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    out = np.empty((len(words), points.shape[1] + 2), np.int32)
    out[:, 0], out[:, -1] = _FIRST, _LAST
    out[:, 1:-1] = np.where((points >= 97) & (points <= 122), points - 96, 27 + points % 34)
    return out


@cache
def _places(length: int) -> tuple[np.ndarray, np.ndarray]:
    """All places (i < j < k) within a span, and how far k lies behind the nearest it can be."""
    found = [
        (i, j, k)
        for i in range(length)
        for j in range(i + 1, min(length, i + SPAN))
        for k in range(j + 1, min(length, i + SPAN))
    ]
    places = np.array(found, np.int32).reshape(-1, ORDER)
    return places, places[:, -1] - places[:, 0] - (ORDER - 1)


#: Weight of a subsequence by how many characters it skips.
_WEIGHTS = (DECAY ** (ORDER + np.arange(SPAN - ORDER + 1))).astype(np.float32)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words of one length: numbers of the subsequences, what each skips, and the norms of the words."""
    codes = _codes(words)
    places, skips = _places(codes.shape[1])
    numbers = (codes[:, places[:, 0]] * _ALPHABET + codes[:, places[:, 1]]) * _ALPHABET + codes[:, places[:, 2]]
    # Equal subsequences of a word count together: sorted, they are neighbours.
    ordered = np.sort(numbers * len(_WEIGHTS) + skips, axis=1)
    weights = _WEIGHTS[ordered % len(_WEIGHTS)]
    ordered //= len(_WEIGHTS)
    new = np.ones(ordered.shape, bool)
    np.not_equal(ordered[:, 1:], ordered[:, :-1], out=new[:, 1:])
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(weights.ravel(), starts)
    first = np.searchsorted(starts, np.arange(len(words)) * ordered.shape[1])
    return numbers, skips, np.sqrt(np.add.reduceat(sums * sums, first))


class Kernel:
    """Kernel values between words and a list of landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.place = np.zeros(_ALPHABET**ORDER, np.int32)
        columns: list[dict[int, float]] = []
        for word in landmarks:
            numbers, skips, norms = subsequences([word])
            column: dict[int, float] = {}
            for number, weight in zip(numbers[0].tolist(), _WEIGHTS[skips].tolist(), strict=True):
                column[number] = column.get(number, 0) + weight / float(norms[0])
            columns.append(column)
        used = sorted({number for column in columns for number in column})
        self.place[used] = np.arange(1, len(used) + 1)
        # Row 0 is for subsequences that no landmark has; one copy of the table per weight.
        self.rows = len(used) + 1
        table = np.zeros((self.rows, len(landmarks)), np.float32)
        for m, column in enumerate(columns):
            table[self.place[list(column)], m] = list(column.values())
        self.weighted = np.concatenate([table * weight for weight in _WEIGHTS])

    def _same_length(self, words: list[str]) -> np.ndarray:
        numbers, skips, norms = subsequences(words)
        found = self.place[numbers]
        found += skips * self.rows
        values = np.zeros((len(words), len(self.landmarks)), np.float32)
        part = np.empty_like(values)
        for column in found.T:
            values += self.weighted.take(column, axis=0, out=part, mode="clip")
        values /= norms[:, None]
        return np.multiply.reduce([values] * POWER)

    def __call__(self, words: list[str], block: int = 256) -> np.ndarray:
        """One row per word; of a long word, the largest value of its pieces."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        by_length: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            by_length.setdefault(len(word), []).append(k)
        for length, where in by_length.items():
            if length > LONGEST:
                for k in where:
                    pieces = _pieces(words[k])
                    parts = [pieces[i : i + block] for i in range(0, len(pieces), block)]
                    values = [self._same_length(p).max(0) for part in parts for p in _by_length(part)]
                    out[k] = np.max(values, axis=0)
            else:
                for i in range(0, len(where), block):
                    some = where[i : i + block]
                    out[some] = self._same_length([words[k] for k in some])
        return out


def _by_length(words: list[str]) -> list[list[str]]:
    return [[w for w in words if len(w) == n] for n in sorted({len(w) for w in words})]


# --- Sentences -----------------------------------------------------------------------------------


def _ends_sentence(chunk: bytes) -> bool:
    return chunk.rstrip(b"\"')]}*#%&$")[-1:] in (b".", b"!", b"?")


def _sentence_starts(ends: np.ndarray) -> np.ndarray:
    """First words of sentences, where ``ends`` marks the last words."""
    n = len(ends)
    first = np.zeros(n, bool)
    first[0] = True
    first[1:] = ends[:-1]
    place = np.arange(n)
    since = place - np.maximum.accumulate(np.where(first, place, 0))
    return np.flatnonzero(since % SENTENCE_WORDS == 0)


def spelled_out(chunks: list[bytes]) -> list[bytes]:
    """Words written letter by letter: runs of at least three single letters, joined."""
    single = np.fromiter(map(len, chunks), np.int64, len(chunks)) == 1
    if not single.any():
        return []
    edges = np.flatnonzero(np.diff(single, prepend=False, append=False)).reshape(-1, 2)
    return [b"".join(chunks[a:b]) for a, b in edges.tolist() if b - a > 2]


# --- Model ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    kernel: Kernel
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def words(self, words: list[str]) -> np.ndarray:
        return self.kernel(words) @ self.weights if words else np.zeros(0)

    def probability(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.offset, -40, 40)))

    def key(self) -> bytes:
        parts = (",".join(self.kernel.landmarks).encode(), self.weights.tobytes(), str(self.bias).encode())
        return hashlib.sha256(b"|".join(parts)).digest()


class Scorer:
    """Scores texts with a model; remembers the numbers of words it has seen, up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.scores = np.zeros(1024, np.float32)
        self.ends = np.zeros(1024, bool)

    def _learn(self, chunks: Iterable[bytes]) -> None:
        new = [c for c in dict.fromkeys(chunks) if c not in self.known]
        if len(self.known) + len(new) > MOST_KNOWN:
            self._forget()
            new = list(dict.fromkeys(chunks))
        owner, words = [], []
        for k, chunk in enumerate(new):
            for word in units(chunk):
                owner.append(k)
                words.append(word)
        best = np.full(len(new), -np.inf, np.float32)
        if words:
            np.maximum.at(best, owner, self.model.words(words).astype(np.float32))
        at = len(self.known)
        while at + len(new) > len(self.scores):
            self.scores, self.ends = np.resize(self.scores, 2 * len(self.scores)), np.resize(self.ends, 2 * len(self.ends))
        self.scores[at : at + len(new)] = np.where(np.isinf(best), 0, best)
        self.ends[at : at + len(new)] = [_ends_sentence(c) for c in new]
        self.known.update(zip(new, range(at, at + len(new)), strict=True))

    def decisions(self, texts: list[bytes]) -> np.ndarray:
        """Decision value of the worst sentence of each text; of no words: that of an empty one."""
        split = [text.split() for text in texts]
        spelled = [spelled_out(chunks) for chunks in split]
        self._learn([c for chunks in [*split, *spelled] for c in chunks])
        out = np.full(len(texts), self.model.bias)
        for k, (chunks, letters) in enumerate(zip(split, spelled, strict=True)):
            if chunks:
                at = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
                sums = np.add.reduceat(self.scores[at], _sentence_starts(self.ends[at]), dtype=np.float64)
                worst = max([sums.max(), *(self.scores[self.known[w]] for w in letters)])
                out[k] = self.model.bias + worst
        return out


_scorers: dict[bytes, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    key = model.key()
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model)
    return _scorers[key]


# --- Fitting -------------------------------------------------------------------------------------


def _landmarks(toxic: Counter, clean: Counter, n_toxic: int, n_clean: int) -> list[str]:
    """Words that toxic documents have and clean ones lack, unlike each other; then frequent clean words."""

    def gain(word: str) -> float:
        return toxic[word] * (
            np.log((toxic[word] + 0.5) / (n_toxic + 1)) - np.log((clean[word] + 0.5) / (n_clean + 1))
        )

    ranked = sorted((w for w, n in toxic.items() if n > 1 and 2 < len(w) <= LONGEST), key=lambda w: (-gain(w), w))
    chosen: list[str] = []
    candidates = ranked[: 8 * TOXIC_LANDMARKS]
    if candidates:
        alike = Kernel(candidates)(candidates)
        taken: list[int] = []
        for k in range(len(candidates)):
            if len(taken) < TOXIC_LANDMARKS and not (taken and alike[k, taken].max() > 0.8):
                taken.append(k)
        chosen = [candidates[k] for k in taken]
    plain = sorted((w for w in clean if 2 < len(w) <= LONGEST and w not in chosen), key=lambda w: (-clean[w], w))
    half = CLEAN_LANDMARKS // 2
    return chosen + plain[:half] + plain[half :: max(1, len(plain) // half)][:half]


def _disguised(word: str, rng: np.random.Generator) -> str:
    """The word with a letter put in, left out, doubled or replaced, not at its ends."""
    at, letter = int(rng.integers(1, len(word) - 1)), chr(97 + int(rng.integers(26)))
    kinds = (
        word[:at] + letter + word[at:], word[:at] + word[at + 1 :],
        word[:at] + word[at] + word[at:], word[:at] + letter + word[at + 1 :],
    )
    return kinds[int(rng.integers(4))]


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, most_steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear machine under squared hinge loss, by Newton steps on its active rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])

    def loss(w):
        slack = np.maximum(0, 1 - y * (x @ w))
        return w @ ridge @ w + cost @ (slack * slack)

    for _ in range(most_steps):
        active = y * (x @ w) < 1
        weighted = x[active] * cost[active, None]
        target = np.linalg.solve(ridge + weighted.T @ x[active], weighted.T @ y[active])
        step, before = 1.0, loss(w)
        while loss(w + step * (target - w)) > before and step > 1e-4:
            step /= 2
        moved = step * (target - w)
        w = w + moved
        if np.abs(moved).max() < 1e-6 * (1 + np.abs(w).max()):
            break
    return w[:-1], float(w[-1])


def _calibrated(decision: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability, by weighted logistic regression on softened labels."""
    positive, negative = weight[y > 0].sum(), weight[y < 0].sum()
    wanted = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.stack([decision, np.ones(len(decision))], 1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(curve, x.T @ (weight * (wanted - p)) - 1e-6 * theta)
        theta = theta + np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def train(texts: list[bytes], toxic: np.ndarray, share: float, seed: int = 11) -> Model | None:
    """Fit on whole texts and their labels; ``share`` is that of toxic documents among all labelled.

    Every toxic sentence is learnt from twice, as it is and with its worst word disguised, so that the
    machine gives weight to subsequences that survive a disguise.
    """
    rng = np.random.default_rng(seed)
    if not toxic.any() or toxic.all():
        return None
    number: dict[str, int] = {}
    of_chunk: dict[bytes, tuple[tuple[int, ...], bool]] = {}
    documents = []  # per document: sentences of chunks
    counts = (Counter(), Counter())
    for text, bad in zip(texts, toxic, strict=True):
        chunks = text.split()
        for chunk in dict.fromkeys(chunks):
            if chunk not in of_chunk:
                words = tuple(number.setdefault(w, len(number)) for w in units(chunk))
                of_chunk[chunk] = (words, _ends_sentence(chunk))
        names = {w for chunk in set(chunks) for w in of_chunk[chunk][0]}
        counts[int(bad)].update(names)
        starts = _sentence_starts(np.array([of_chunk[c][1] for c in chunks], bool)).tolist() if chunks else []
        edges = [*starts, len(chunks)]
        documents.append([chunks[a:b] for a, b in zip(edges, edges[1:])])
    vocabulary = list(number)
    clean_names, toxic_names = (Counter({vocabulary[k]: n for k, n in c.items()}) for c in counts)
    landmarks = _landmarks(toxic_names, clean_names, int(toxic.sum()), int((~toxic).sum()))
    if not landmarks:
        return None
    kernel = Kernel(landmarks)
    values, vectors = np.linalg.eigh(kernel(landmarks).astype(np.float64))
    whiten = vectors * np.where(values > 1e-6, np.maximum(values, 1e-6) ** -0.5, 0)

    def word_scores(weights: np.ndarray) -> np.ndarray:
        parts = [kernel(vocabulary[k : k + 20_000]) @ weights for k in range(0, len(vocabulary), 20_000)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def worst(scores: np.ndarray) -> tuple[list[list[bytes]], np.ndarray]:
        """The sentence of each document with the largest sum, and that sum."""
        of = {c: max((scores[w] for w in words), default=0.0) for c, (words, _) in of_chunk.items()}
        chosen, sums = [], np.zeros(len(documents))
        for k, sentences in enumerate(documents):
            totals = [sum(map(of.__getitem__, s)) for s in sentences]
            best = int(np.argmax(totals)) if totals else 0
            chosen.append(sentences[best] if totals else [])
            sums[k] = totals[best] if totals else 0.0
        return chosen, sums

    def disguised(sentences: list[list[bytes]], scores: np.ndarray) -> np.ndarray:
        """The sentences with their worst word disguised; those of longer words only."""
        changes, kept = [], []
        for k, sentence in enumerate(sentences):
            words = [w for c in sentence for w in of_chunk[c][0]]
            word = vocabulary[max(words, key=scores.__getitem__)] if words else ""
            if 3 < len(word) <= LONGEST:
                kept.append(k)
                changes.append((word, _disguised(word, rng)))
        if not kept:
            return np.zeros((0, whiten.shape[1]))
        plain, hidden = (kernel([c[i] for c in changes]).astype(np.float64) @ whiten for i in (0, 1))
        return embedded([sentences[k] for k in kept], scores) + hidden - plain

    def embedded(sentences: list[list[bytes]], scores: np.ndarray) -> np.ndarray:
        """Sum over the words of a sentence; of a stretch with several readings, the worst one."""
        read = [
            [max(of_chunk[c][0], key=scores.__getitem__) for c in s if of_chunk[c][0]] for s in sentences
        ]
        used = sorted({w for s in read for w in s})
        place = {w: k for k, w in enumerate(used)}
        rows = kernel([vocabulary[w] for w in used]).astype(np.float64) @ whiten
        out = np.zeros((len(sentences), whiten.shape[1]))
        for k, s in enumerate(read):
            if s:
                out[k] = rows[[place[w] for w in s]].sum(0)
        return out

    # Start from likeness to the words that mark toxic documents.
    marks = np.array([toxic_names[w] > 4 * clean_names[w] * toxic.sum() / (~toxic).sum() for w in landmarks])
    scores = word_scores(marks.astype(np.float32))
    y = np.where(toxic, 1.0, -1.0)
    x, labels = np.zeros((0, whiten.shape[1])), np.zeros(0)
    for _ in range(ROUNDS):
        chosen, _ = worst(scores)
        hidden = disguised([s for s, bad in zip(chosen, toxic, strict=True) if bad], scores)
        # Clean sentences of earlier rounds stay; a toxic document has one sentence, plain and disguised.
        x = np.vstack([x[labels < 0], embedded(chosen, scores), hidden])
        labels = np.concatenate([labels[labels < 0], y, np.ones(len(hidden))])
        cost = np.where(labels > 0, len(labels) / 2 / (labels > 0).sum(), len(labels) / 2 / (labels < 0).sum())
        # A sentence without words is clean, whatever the others say.
        empty = np.zeros((1, x.shape[1]))
        w, bias = _machine(np.vstack([x, empty]), np.append(labels, -1.0), np.append(cost, cost.sum() / 10))
        weights = whiten @ w
        scores = word_scores(weights)
    decision = worst(scores)[1] + bias
    weight = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    slope, offset = _calibrated(decision, y, weight)
    return Model(kernel, weights.astype(np.float32), bias, slope, offset)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    most_toxic: int = MOST_TOXIC,
    most_clean: int = MOST_CLEAN,
) -> Model | None:
    """Fit on at most ``most_toxic`` and ``most_clean`` labelled documents, those of the smallest hashes.

    NULL ids and labels are left out; an id with different labels counts as toxic.  Without toxic or
    without clean documents there is no model: None.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(id_col).agg(F.max(label_col).alias("label"))
    )
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}

    def chosen(label: int, most: int) -> DataFrame:
        return known.where(F.col("label") == label).orderBy(F.xxhash64(id_col), id_col).limit(most)

    # A bound that does not grow: at most ``most_toxic`` + ``most_clean`` ids.
    sample = F.broadcast(chosen(1, most_toxic).unionByName(chosen(0, most_clean)))
    texts = documents.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    rows = sorted(
        (int(r[0]), r[1].encode())
        for r in texts.join(sample, id_col).select("label", text_col).toLocalIterator()
    )
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    return train([t for _, t in rows], np.array([bad == 1 for bad, _ in rows], bool), share)


def score(model: Model | None, text: Column) -> Column:
    """Probability that a text is toxic; NULL counts as empty.  Without a model, zero."""
    if model is None:
        return F.lit(SCORE_WITHOUT_MODEL)

    @arrow_udf(T.DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _scorer(model)
        for texts in batches:
            values = list(text_bytes(texts))
            found = [
                scorer.decisions(values[k : k + TEXTS_AT_A_TIME]) for k in range(0, len(values), TEXTS_AT_A_TIME)
            ]
            yield pa.array(model.probability(np.concatenate(found) if found else np.zeros(0)), pa.float64())

    return scored(text)


def score_toxicity(spark, sf_dir) -> DataFrame:
    """One row per document: doc_id, held_out (false for a NULL id), score, predicted."""
    small_batches(spark)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = id_remainder(F.col("doc_id"), HELD_OUT_PARTS)
    labels = table(spark, sf_dir, "labels").where(remainder != HELD_OUT)
    model = fit(documents, labels)
    held_out = F.coalesce(remainder == HELD_OUT, F.lit(False))
    return documents.select(
        "doc_id", held_out.alias("held_out"), score(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
