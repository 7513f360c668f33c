"""Toxicity by a support vector machine on a subsequence string kernel.

The kernel of two words counts the three-letter subsequences they share, ends marked;
up to two letters may be inserted within an occurrence, each costing half its weight.
So misspelt, stretched and punctuated insults stay close to the plain ones. Nystroem
landmarks (words of the labelled texts) turn the kernel into a feature map of fixed
size. A text is as toxic as its worst word: training repeats choosing the witness
word of every toxic text and the hardest words of the clean ones (MI-SVM), starting
from all words. A linear machine over landmark kernels is a sum of weights of
subsequences, which is how texts are scored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retailpulse.llm.common import held_out, slices

LENGTH = 3
INSERTED = 2
DECAY = 0.5
LANDMARKS = 192
#: Most labelled texts of either class that the machine is fitted on, the lowest hashes of doc_id first.
SAMPLE_PER_CLASS = 1500
#: Instances whose features are computed at a time; only those of witnesses and hard negatives are kept.
PART = 5000
ROUNDS = 5
FOLDS = 5
#: Longer words are looked at in overlapping windows of this size.
WINDOW = 30

OFFSETS = [(0, *c) for c in combinations(range(1, LENGTH + INSERTED), LENGTH - 1)]
WEIGHTS = [DECAY ** (o[-1] + 1 - LENGTH) for o in OFFSETS]
_PUNCTUATION = re.compile(r"[\W_]+")


def raw_words(text: str) -> list[str]:
    """Lower-case words as they stand, with runs of three or more single characters joined too."""
    found = text.lower().split()
    if list(map(len, found)).count(1) >= LENGTH:
        run: list[str] = []
        for word in [*found, ""]:
            if len(word) == 1:
                run.append(word)
            else:
                if len(run) >= LENGTH:
                    found.append("".join(run))
                run = []
    return found


def plain(word: str) -> str:
    """Letters and digits of a word."""
    return word if word.isalnum() else _PUNCTUATION.sub("", word)


def windows(word: str) -> list[str]:
    marked = f"^{word}$"
    if len(marked) <= WINDOW:
        return [marked]
    step = WINDOW - LENGTH - INSERTED
    return [marked[k:k + WINDOW] for k in range(0, len(marked) - LENGTH - INSERTED, step)]


def occurrences(marked: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, codes, weights) of the subsequences of equally long words, scaled to unit length.

    One code holds the three characters of a subsequence, 21 bits each.
    """
    by_length: dict[int, list[int]] = defaultdict(list)
    for row, word in enumerate(marked):
        by_length[len(word)].append(row)
    for length, rows in by_length.items():
        chars = np.array([marked[r] for r in rows], f"<U{length}").view(np.uint32).reshape(len(rows), length)
        chars = chars.astype(np.uint64)
        columns, weights = [], []
        for offset, weight in zip(OFFSETS, WEIGHTS):
            span = length - offset[-1]
            if span > 0:
                a, b, c = (chars[:, o:o + span] for o in offset)
                columns.append(a << np.uint64(42) | b << np.uint64(21) | c)
                weights += [weight] * span
        if columns:
            scaled = np.array(weights) / np.sqrt(np.square(weights).sum())
            yield np.array(rows), np.concatenate(columns, axis=1), scaled


def looked_up(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index of each code in the sorted ``table``; its length where it is absent."""
    at = np.searchsorted(table, codes)
    return np.where(table[np.minimum(at, len(table) - 1)] == codes, at, len(table))


@dataclass
class Machine:
    """Weights of subsequence codes; ``slope`` and ``shift`` turn a margin into a probability."""

    codes: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    constant: float | None = None

    def margins(self, words: list[str]) -> np.ndarray:
        """One margin per word; of a long word, the largest of its windows; of none, minus infinity."""
        marked, owner = [], []
        for k, word in enumerate(words):
            for piece in windows(word) if word else []:
                marked.append(piece)
                owner.append(k)
        sums = np.zeros(len(marked))
        padded = np.append(self.weights, 0.0)
        for rows, codes, scaled in occurrences(marked):
            sums[rows] = padded[looked_up(codes, self.codes)] @ scaled
        out = np.full(len(words), -np.inf)
        np.maximum.at(out, np.array(owner, int), sums + self.bias)
        return out

    def probability(self, margin: float) -> float:
        if self.constant is not None:
            return self.constant
        return float(1 / (1 + np.exp(-np.clip(self.slope * max(margin, -3.0) + self.shift, -30, 30))))


def kernel(marked: list[str], codes: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Kernel of each window of a word with the landmarks, given their code weights."""
    out = np.zeros((len(marked), columns.shape[1]), np.float32)
    padded = np.concatenate([columns, np.zeros((1, columns.shape[1]), np.float32)])
    for rows, found, scaled in occurrences(marked):
        for part in range(0, len(rows), 2000):
            at = looked_up(found[part:part + 2000], codes)
            total = np.zeros((len(at), columns.shape[1]), np.float32)
            for column in range(at.shape[1]):
                total += padded[at[:, column]] * np.float32(scaled[column])
            out[rows[part:part + 2000]] = total
    return out


def landmark_weights(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of all landmarks (windows of words) and each landmark's weight of them."""
    found = list(occurrences(landmarks))
    codes = np.unique(np.concatenate([c.ravel() for _, c, _ in found]))
    columns = np.zeros((len(codes), len(landmarks)), np.float32)
    for rows, own, scaled in found:
        for k, row in enumerate(rows):
            np.add.at(columns[:, row], np.searchsorted(codes, own[k]), scaled)
    return codes, columns


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Primal Newton solution of the linear machine; ``x`` ends with a column of ones."""
    v = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(20):
        active = y * (x @ v) < 1
        part, w = x[active], weight[active]
        gradient = penalty * v + part.T @ (w * (part @ v - y[active]))
        if np.abs(gradient).max() < 1e-7:
            break
        v = v - np.linalg.solve(np.diag(penalty) + (part * w[:, None]).T @ part, gradient)
    return v


def logistic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the class probability, a little smoothed."""
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    v = np.zeros(2)
    target = np.where(y > 0, 1 - 1 / (2 + (y > 0).sum()), 1 / (2 + (y < 0).sum()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + np.array([1e-6, 1e-6]) * v
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        v = v - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(v[0]), float(v[1])


def fit_words(texts: list[list[str]], toxic: list[int], prior: float) -> Machine:
    """Machine of the distinct words of labelled texts; ``prior`` is the share of toxic ones.

    Every window of a word is an instance of its own, as in ``Machine.margins``.
    """
    y = np.where(np.array(toxic, int) > 0, 1.0, -1.0)
    if not len(y) or len(set(y)) < 2:
        return Machine(np.zeros(1, np.uint64), np.zeros(1), 0.0, 1.0, 0.0, constant=float(prior))
    n_bad, n_good = int((y > 0).sum()), int((y < 0).sum())
    bad, good = defaultdict(int), defaultdict(int)
    known: dict[str, list[str]] = {}
    for word in set().union(*texts) - {""}:
        known[word] = windows(word)
    texts = [sorted(set().union(*(known[w] for w in words if w))) for words in texts]
    for words, label in zip(texts, y):
        for word in words:
            (bad if label > 0 else good)[word] += 1
    vocabulary = sorted({*bad, *good}, key=lambda w: (-(bad[w] + good[w]), w))
    at = {w: k for k, w in enumerate(vocabulary)}
    p = np.array([bad[w] for w in vocabulary]) / n_bad
    q = np.array([good[w] for w in vocabulary]) / n_good
    score = (p - q) / np.sqrt((p + q) / 2 * (1 / n_bad + 1 / n_good) + 1e-9)
    typical = np.argsort(-score, kind="stable")[: LANDMARKS // 2]
    chosen = set(typical.tolist())
    common = [k for k in range(len(vocabulary)) if k not in chosen][: LANDMARKS // 2]
    landmarks = [vocabulary[k] for k in [*typical, *common]]
    codes, columns = landmark_weights(landmarks)
    values, vectors = np.linalg.eigh(columns.T.astype(float) @ columns)
    keep = values > 1e-4 * values.max()
    back = vectors[:, keep] / np.sqrt(values[keep])

    def features(marked: list[str]) -> np.ndarray:
        x = np.ones((len(marked), back.shape[1] + 1))
        x[:, :-1] = kernel(marked, codes, columns) @ back
        return x

    def margins(v: np.ndarray) -> np.ndarray:
        line = np.append(columns.astype(float) @ (back @ v[:-1]), 0.0)
        out = np.full(len(vocabulary), v[-1])
        for part in range(0, len(vocabulary), PART):
            for rows, found, scaled in occurrences(vocabulary[part:part + PART]):
                out[part + rows] += line[looked_up(found, codes)] @ scaled
        return out

    gram, pull = 1e-2 * np.eye(back.shape[1] + 1), np.zeros(back.shape[1] + 1)
    for part in range(0, len(vocabulary), PART):
        some = slice(part, part + PART)
        own = features(vocabulary[some])
        gram += (own * (p + q)[some, None]).T @ own
        pull += own.T @ (p - q)[some]
    # Start: every word takes its text's label.
    v = np.linalg.solve(gram, pull)
    members = [np.array([at[w] for w in words], int) for words in texts]
    hard: set[int] = set()
    kept: dict[int, np.ndarray] = {}
    for _ in range(ROUNDS):
        f = margins(v)
        witness = [int(m[f[m].argmax()]) for m, label in zip(members, y) if label > 0 and len(m)]
        for m, label in zip(members, y):
            if label < 0 and len(m):
                hard.update(m[np.argsort(-f[m])[:3]].tolist())
        # Words that clean texts hold about as often witness nothing.
        witness = [k for k in witness if p[k] > 2 * q[k]]
        if not witness or not hard:
            break
        negative = np.array(sorted(hard.difference(witness)), int)
        rows = np.concatenate([np.array(witness, int), negative])
        label = np.concatenate([np.ones(len(witness)), -np.ones(len(negative))])
        weight = np.where(label > 0, 10 / len(witness), 10 / max(1, len(negative)))
        new = sorted(set(rows.tolist()).difference(kept))
        kept.update(zip(new, features([vocabulary[k] for k in new]).astype(np.float32)))
        v = squared_hinge(np.stack([kept[k] for k in rows.tolist()]).astype(float), label, weight, 1e-2)
    f = margins(v)
    margin = np.array([f[m].max() if len(m) else f.min() for m in members])
    weight = np.where(y > 0, prior / n_bad, (1 - prior) / n_good) * len(y)
    slope, shift = logistic(margin, y, weight)
    beta = back @ v[:-1]
    return Machine(codes, columns.astype(float) @ beta, float(v[-1]), slope, shift)


def fit(docs: DataFrame, labels: DataFrame, folds: int | None = FOLDS, per_class: int = SAMPLE_PER_CLASS) -> Machine:
    """Machine learned from ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks.

    Only rows outside the held-out fold count (all rows if ``folds`` is None). At most
    ``per_class`` texts of either label are used. Null labels and ids are left out; an
    id that is marked twice is toxic if one mark says so.
    """
    marks = labels.where("doc_id is not null and toxic is not null")
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    if folds:
        marks = marks.where(~held_out(folds))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().join(marks, "doc_id")
    counts = {r["toxic"] > 0: r["n"] for r in known.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = known.where("toxic > 0").orderBy(*order).limit(per_class)
    chosen = chosen.union(known.where("toxic <= 0").orderBy(*order).limit(per_class)).cache()

    def words(batches):
        for batch in batches:
            found = [sorted({plain(w) for w in raw_words(t)} - {""}) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.string()))],
                names=["doc_id", "toxic", "words"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # At most 2 * per_class ids: small whatever the input.
    texts = texts.join(F.broadcast(chosen.select("doc_id", F.col("toxic").cast("int").alias("toxic"))), "doc_id")
    found = texts.mapInArrow(words, "doc_id long, toxic int, words array<string>").toArrow()
    chosen.unpersist()
    # One string object per distinct word.
    kept: dict[str, str] = {}
    rows = sorted(
        (i, [kept.setdefault(w, w) for w in own.as_py()], y)
        for i, own, y in zip(found["doc_id"].to_pylist(), found["words"], found["toxic"].to_pylist())
    )
    n_bad, n_good = counts.get(True, 0), counts.get(False, 0)
    prior = (n_bad + 1) / (n_bad + n_good + 2) if n_bad and n_good else (0.99 if n_bad else 0.01)
    return fit_words([r[1] for r in rows], [r[2] for r in rows], prior)


def scored(docs: DataFrame, machine: Machine, column: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out`` (double): the probability that a text is toxic.

    Null, empty and wordless texts get the score of the cleanest text. A column
    already named ``out`` is replaced; all rows and other columns are kept.
    """
    kept = [c for c in docs.columns if c != out]
    chosen = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = StructType(list(chosen.schema.fields)).add(out, "double")
    remembered = 400_000

    def run(batches):
        known: dict[str, float] = {}
        for batch in batches:
            texts = [t or "" for t in batch.column(column).to_pylist()]
            found = []
            for some in slices(texts):
                words = [raw_words(t) for t in some]
                new = list(set().union(*words).difference(known))
                if len(known) + len(new) > remembered:
                    known.clear()
                    new = list(set().union(*words))
                for part in range(0, len(new), 20_000):
                    names = new[part:part + 20_000]
                    known.update(zip(names, machine.margins([plain(w) for w in names]).tolist()))
                found += [machine.probability(max(map(known.__getitem__, w), default=-np.inf)) for w in words]
            arrays = [batch.column(c) for c in kept] + [pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, out])

    return chosen.mapInArrow(run, schema)
