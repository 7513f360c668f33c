"""Language-model scores of texts: every word, seen or not, by the marginal of a subword lattice and by counts.

A token is a word or the end of a text. A unigram model over an existing vocabulary of
pieces adds up all segmentations of a word: the first piece carries the word mark, the
others follow until a stop. The marginal probability comes from a forward recursion in
log space over the lattice of pieces. The vocabulary's own scores start the piece
weights; expectation maximisation over all distinct training words (forward-backward
over the same lattice) adapts them. A word's probability is the lattice's marginal, its
discounted frequency in its class and its frequency in all classes, by shares of a grid
(``SHARES``) that make the training words likeliest when each occurrence is left out of
the counts in turn: a count helps as far as it foretells words, the lattice does the rest.
Training texts of different classes (languages) have counts, piece weights and shares of
their own; a text's probability is the sum over the classes, whatever its own is.

Counts meet the texts without any word being sent per document: texts are dealt into
chunks of bounded size, each chunk asks once for each of its distinct words.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpulse.llm.common import held_out, stored, text_bytes

MARK = "▁"
#: Added to every count of the base model; fixed value.
BASE_ADDED = 0.1
ITERATIONS = 2
#: Added to the expected count of every piece.
SMOOTHING = 0.02
#: A class of its own holds at least this share of the training texts, so there are at most
#: as many as its inverse; rarer values, and null, share the last class.
MIN_SHARE = 1 / 16
#: Shares of a word's probability tried: of the lattice, and of the counts of all classes. The rest is the class's own counts'.
SHARES = [
    (lattice, whole)
    for lattice in (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0)
    for whole in (0.0, 0.02, 0.05, 0.1, 0.2, 0.4)
    if lattice + whole <= 1
]
CHUNK_BYTES = 24_000_000
#: Words up to this length go through the recursion in arrays of equal lengths, longer ones alone.
ARRAY_LENGTH = 64
#: Characters of the words in one array, and words gathered to fill arrays of every length.
ARRAY_CELLS = 200_000
GATHERED = 120_000
FOLDS = 10

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 20


def read_pieces(path: str) -> tuple[list[str], list[float]]:
    """Pieces of a vocabulary that stand for text, and scores; byte pieces come as <0xHH>."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return [model.id_to_piece(i) for i in kept], [model.get_score(i) for i in kept]


@dataclass
class Weights:
    """Natural logs: ``pieces`` aligned with the vocabulary (bytes included), and of the stop."""

    names: list[str]
    logs: np.ndarray
    stop: float


def start_weights(path: str) -> Weights:
    """From the vocabulary's scores. Scores that are merge ranks become a Zipf law over the ranks."""
    names, scores = read_pieces(path)
    order = np.argsort(-np.array(scores), kind="stable")
    logs = np.empty(len(names))
    logs[order] = -np.log(np.arange(len(names)) + 10.0)
    return normalised(names, np.exp(logs), 0.2)


def normalised(names: list[str], counts: np.ndarray, stop: float) -> Weights:
    """Counts as two distributions: of first pieces, and of later pieces with the stop."""
    first = np.array([n.startswith(MARK) for n in names])
    logs = np.log(counts)
    total = counts[~first].sum()
    stop = stop * total if stop < 1 else stop
    logs[first] -= np.log(counts[first].sum())
    logs[~first] -= np.log(total + stop)
    return Weights(names, logs, float(np.log(stop) - np.log(total + stop)))


class Lattice:
    """All segmentations of words, many words of one length at a time."""

    def __init__(self, names: list[str]):
        self.size = len(names)
        self.byte = {int(n[3:5], 16): k for k, n in enumerate(names) if len(n) == 6 and n.startswith("<0x")}
        text = [k for k in range(len(names)) if k not in set(self.byte.values())]
        self.number = {names[k]: k for k in text}
        self.longest = max(len(names[k]) for k in text)
        self.prefixes = {names[k][:j] for k in text for j in range(1, len(names[k]) + 1)}
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.full(self.longest + 1, _BASE, np.uint64)) * np.uint64(0xD1B54A32D192ED03)
            hashes = np.array([self._hash(names[k]) for k in text], np.uint64)
        # A slot names its first piece, a piece the next one of its slot.
        self.hashes = np.zeros(len(names), np.uint64)
        self.hashes[text] = hashes
        self.slot = np.full(1 << _SLOTS, -1, np.int32)
        self.next = np.full(len(names), -1, np.int32)
        for k, slot in zip(text, (hashes >> np.uint64(64 - _SLOTS)).tolist()):
            self.next[k], self.slot[slot] = self.slot[slot], k
        self.fallbacks: dict[int, list[int]] = {}

    def _hash(self, piece: str) -> np.uint64:
        chars = np.frombuffer(piece.encode("utf-32-le"), np.uint32).astype(np.uint64)
        return (chars * self.powers[: len(chars)][::-1]).sum(dtype=np.uint64)

    def fallback(self, char: int, weights: Weights) -> tuple[float, list[int]]:
        """Log weight and byte pieces of a character that no piece stands for."""
        if char not in self.fallbacks:
            self.fallbacks[char] = [self.byte[b] for b in chr(char).encode("utf-8", "replace")]
        ids = self.fallbacks[char]
        return float(weights.logs[ids].sum()), ids

    def cells(self, words: list[str]):
        """Characters of equally long words, their mark included, and {(i, j): piece numbers}, -1 for none."""
        length = len(words[0])
        chars = np.array(words, f"<U{length}").view(np.uint32).reshape(len(words), length)
        wide = chars.astype(np.uint64)
        found = {}
        for i in range(length):
            with np.errstate(over="ignore"):
                value = np.zeros(len(words), np.uint64)
                for j in range(i + 1, min(length, i + self.longest) + 1):
                    # Appending a character multiplies what is there by the base.
                    value = value * _BASE + wide[:, j - 1] * self.powers[0]
                    numbers = self.slot[(value >> np.uint64(64 - _SLOTS)).view(np.int64)]
                    rows = np.flatnonzero(numbers >= 0)
                    while len(rows):
                        rows = rows[self.hashes[numbers[rows]] != value[rows]]
                        numbers[rows] = self.next[numbers[rows]]
                        rows = rows[numbers[rows] >= 0]
                    if j == i + 1 or (numbers >= 0).any():
                        found[i, j] = numbers
        return chars, found

    def weighed(self, chars: np.ndarray, cells, weights: Weights, kind=np.float64):
        """{(i, j): log weights} of the cells."""
        padded = np.append(weights.logs, -np.inf).astype(kind)
        found = {}
        for (i, j), numbers in cells.items():
            logs = padded[numbers]
            if j == i + 1:
                missing = np.flatnonzero(numbers < 0)
                logs[missing] = [self.fallback(int(c), weights)[0] for c in chars[missing, i]]
            found[i, j] = logs
        return found

    @staticmethod
    def forward(logs, n: int, length: int) -> np.ndarray:
        alpha = np.full((length + 1, n), -np.inf, logs[0, 1].dtype)
        alpha[0] = 0.0
        for (i, j), weight in logs.items():
            alpha[j] = np.logaddexp(alpha[j], alpha[i] + weight)
        return alpha

    def grouped(self, words: list[str]):
        by_length = defaultdict(list)
        for k, word in enumerate(words):
            by_length[len(word) + 1].append(k)
        for length, rows in by_length.items():
            # Long arrays at a time, of bounded size over all cells.
            step = max(1, ARRAY_CELLS // length)
            for part in range(0, len(rows), step):
                yield length, rows[part:part + step]

    def log_marginals(self, words: list[str], several: list[Weights]) -> np.ndarray:
        """Natural log of the summed probability of all segmentations, stop included; a row per weights."""
        out = np.empty((len(several), len(words)))
        for length, rows in self.grouped(words):
            if length > ARRAY_LENGTH:
                for k, weights in enumerate(several):
                    out[k, rows] = [self.alone(MARK + words[r], weights)[0][-1] for r in rows]
                continue
            chars, cells = self.cells([MARK + words[r] for r in rows])
            for k, weights in enumerate(several):
                out[k, rows] = self.forward(self.weighed(chars, cells, weights), len(rows), length)[-1]
        return out + np.array([[w.stop] for w in several])

    def alone(self, word: str, weights: Weights) -> tuple[list[float], list[list[tuple[int, float, list[int]]]]]:
        """Forward logs of one word, and for each end the arcs (start, log weight, pieces)."""
        logs, number = weights.logs, self.number
        arcs: list[list[tuple[int, float, list[int]]]] = [[] for _ in range(len(word) + 1)]
        for i in range(len(word)):
            if word[i] not in number:
                weight, ids = self.fallback(ord(word[i]), weights)
                arcs[i + 1].append((i, weight, ids))
            for j in range(i + 1, min(len(word), i + self.longest) + 1):
                piece = word[i:j]
                if piece not in self.prefixes:
                    break
                if piece in number:
                    arcs[j].append((i, float(logs[number[piece]]), [number[piece]]))
        alpha = [0.0] + [-math.inf] * len(word)
        for j in range(1, len(word) + 1):
            alpha[j] = float(np.logaddexp.reduce([alpha[i] + w for i, w, _ in arcs[j]])) if arcs[j] else -math.inf
        return alpha, arcs

    def expected(self, words: list[str], weights: Weights, marginals: np.ndarray | None = None) -> np.ndarray:
        """Expected number of uses of each piece over all segmentations of ``words``.

        Their log marginals, stop included, go to ``marginals``.
        """
        marginals = np.empty(len(words)) if marginals is None else marginals
        counts = np.zeros(self.size)
        for length, rows in self.grouped(words):
            if length > ARRAY_LENGTH:
                for r in rows:
                    marginals[r] = self._expected_alone(MARK + words[r], weights, counts) + weights.stop
                continue
            chars, cells = self.cells([MARK + words[r] for r in rows])
            # Single precision is enough for expected counts.
            logs = self.weighed(chars, cells, weights, np.float32)
            alpha = self.forward(logs, len(rows), length)
            marginals[rows] = alpha[-1] + weights.stop
            beta = np.full((length + 1, len(rows)), -np.inf, np.float32)
            beta[length] = 0.0
            for i, j in sorted(cells, key=lambda c: -c[0]):
                beta[i] = np.logaddexp(beta[i], logs[i, j] + beta[j])
            for (i, j), numbers in cells.items():
                share = np.exp(alpha[i] + logs[i, j] + beta[j] - alpha[-1])
                known = numbers >= 0
                counts += np.bincount(numbers[known], share[known], minlength=self.size)
                if j == i + 1:
                    for r in np.flatnonzero(~known):
                        counts[self.fallback(int(chars[r, i]), weights)[1]] += share[r]
        return counts

    def _expected_alone(self, word: str, weights: Weights, counts: np.ndarray) -> float:
        alpha, arcs = self.alone(word, weights)
        beta = [-math.inf] * len(word) + [0.0]
        for j in range(len(word), 0, -1):
            for i, weight, ids in arcs[j]:
                beta[i] = float(np.logaddexp(beta[i], weight + beta[j]))
                share = math.exp(min(0.0, alpha[i] + weight + beta[j] - alpha[-1]))
                for k in ids:
                    counts[k] += share
        return alpha[-1]


def gathered(batches, rows: int = GATHERED):
    """Consecutive batches as tables of about so many rows."""
    some, held = [], 0
    for batch in batches:
        some.append(batch)
        held += batch.num_rows
        if held >= rows:
            yield pa.Table.from_batches(some).combine_chunks()
            some, held = [], 0
    if held:
        yield pa.Table.from_batches(some).combine_chunks()


def tokens(text: bytes) -> list[bytes]:
    """Words: runs of other bytes than ASCII white space, A-Z lower-cased."""
    return text.lower().split()


@dataclass
class Counts:
    """Of one class's training texts, or of all."""

    texts: int
    tokens: int  # without ends
    types: int
    once: int
    twice: int

    @property
    def discount(self) -> float:
        return self.once / (self.once + 2 * self.twice) if self.twice else 0.5

    @property
    def size(self) -> int:
        return self.tokens + self.texts

    @property
    def end(self) -> float:
        return (self.texts + 0.5) / (self.size + 1)

    def direct(self, counts: np.ndarray, without: int = 0) -> np.ndarray:
        """Discounted relative frequencies of words; with ``without`` 1, as if one occurrence of each were missing."""
        mass = self.tokens - without - self.discount * self.types
        return np.maximum(counts - without - self.discount, 0) / mass if mass > 0 else np.zeros(len(counts))


def mixed(lattice: np.ndarray, own: np.ndarray, whole: np.ndarray, shares: tuple[float, float]) -> np.ndarray:
    """Natural logs of words' probabilities, from the lattice's logs and the frequencies by counts."""
    by_lattice, by_whole = shares
    with np.errstate(divide="ignore"):
        # In logs: the lattice's part may be too small for a double.
        return np.logaddexp(np.log(max(0.0, 1 - by_lattice - by_whole) * own + by_whole * whole), lattice + math.log(by_lattice))


def best_shares(likelihoods: np.ndarray) -> tuple[float, float]:
    """The first of ``SHARES`` that none exceeds but by rounding."""
    top = likelihoods.max()
    return SHARES[int(np.argmax(likelihoods >= top - abs(top) * 1e-9))]


def chunked(
    docs: DataFrame, folds: int, chunk_bytes: int, class_column: str | None, min_share: float
) -> tuple[DataFrame, int, list[int]]:
    """(chunk, doc_id, held_out, data, class), the number of chunks and that of the training texts of each class.

    As many chunks as the size of all texts asks for.
    """
    size = docs.agg(F.sum(F.octet_length(text_bytes()))).first()[0] or 0
    n = max(1, math.ceil(size / chunk_bytes))
    name = F.col(f"`{class_column}`").cast("string") if class_column else F.lit("all")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"), name.alias("name"))
    keyed = keyed.withColumn("held_out", held_out(folds))
    found = keyed.where("not held_out").groupBy("name").count()
    total = found.agg(F.sum("count")).first()[0] or 0
    # At most 1 / min_share names reach the driver.
    top = found.where("name is not null").where(F.col("count") >= max(1, min_share * total)).orderBy(F.desc("count"), "name").collect()
    names, texts = [r["name"] for r in top], [r["count"] for r in top]
    texts.append(total - sum(texts))
    number = F.lit(len(names))
    for k, value in enumerate(names):
        number = F.when(F.col("name") == value, k).otherwise(number)
    keyed = keyed.withColumn("class", number.cast("int")).drop("name")
    return keyed.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "data"), F.lit(n)).cast("int")), n, texts


def counted(n_classes: int) -> list[str]:
    return [f"n{k}" for k in range(n_classes)]


def chunk_words(keyed: DataFrame, n_chunks: int, n_classes: int) -> DataFrame:
    """(chunk, word, n0, n1, ...): each chunk's distinct words with their number in each class's training texts.

    A task holds the words of one chunk at a time.
    """
    names = counted(n_classes)

    def emitted(chunk: int, counters: list[Counter]):
        words = list(set().union(*counters))
        for part in range(0, len(words), 50_000):
            some = words[part:part + 50_000]
            numbers = [pa.array([c.get(w, 0) for w in some], pa.int64()) for c in counters[:n_classes]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk] * len(some), pa.int32()), pa.array(some, pa.binary()).cast(pa.string()), *numbers],
                names=["chunk", "word", *names],
            )

    def run(batches):
        now, counters = None, [Counter() for _ in range(n_classes + 1)]
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("chunk", "held_out", "class", "data")]
            for chunk, held, number, data in zip(*columns):
                if chunk != now:
                    yield from emitted(now, counters)
                    now, counters = chunk, [Counter() for _ in range(n_classes + 1)]
                if held:
                    counters[n_classes].update(dict.fromkeys(tokens(data), 0))
                else:
                    counters[number].update(tokens(data))
        yield from emitted(now, counters)

    schema = "chunk int, word string, " + ", ".join(f"{n} long" for n in names)
    dealt = keyed.select("chunk", "held_out", "class", "data").repartition(n_chunks, "chunk")
    return dealt.sortWithinPartitions("chunk").mapInArrow(run, schema)


def piece_counts(words: DataFrame, several: list[Weights], classes: list[Counts], tokens_of_all: int) -> tuple[np.ndarray, np.ndarray]:
    """Per class: expected piece counts over its words, and the log likelihood of its tokens under each of ``SHARES``.

    Each token is left out of the counts that judge it. One row per class and piece reaches the driver.
    """
    names, size = counted(len(several)), len(several[0].names)

    def run(batches):
        lattice, counts = Lattice(several[0].names), np.zeros((len(several), size + len(SHARES)))
        for batch in gathered(batches):
            words = batch["word"].to_pylist()
            numbers = np.stack([batch[c].to_numpy() for c in names]).astype(float)
            total = numbers.sum(axis=0)
            for k, weights in enumerate(several):
                own = np.flatnonzero(numbers[k])
                logs = np.empty(len(own))
                counts[k, :size] += lattice.expected([words[r] for r in own], weights, logs)
                direct = classes[k].direct(numbers[k, own], 1)
                whole = (total[own] - 1) / max(1, tokens_of_all - 1)
                for g, shares in enumerate(SHARES):
                    counts[k, size + g] += numbers[k, own] @ mixed(logs, direct, whole, shares)
        kind, piece = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(counts[kind, piece])],
            names=["class", "piece", "n"],
        )

    found = words.select("word", *names).mapInArrow(run, "class int, piece int, n double")
    found = found.groupBy("class", "piece").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(several), size + len(SHARES)))
    counts[found["class"].to_numpy(), found["piece"].to_numpy()] = found["n"].to_numpy()
    return counts[:, :size], counts[:, size:]


def word_logs(words: DataFrame, several: list[Weights], classes: list[Counts], shares: list[tuple], tokens_of_all: int) -> DataFrame:
    """(word, c, p0, p1, ...): the count of each of ``words`` and its log10 probability in each class."""
    names, n = counted(len(several)), len(several)

    def run(batches):
        lattice = Lattice(several[0].names)
        for batch in gathered(batches):
            counts = np.stack([batch[c].to_numpy() for c in names]).astype(float)
            logs = lattice.log_marginals(batch["word"].to_pylist(), several)
            total = counts.sum(axis=0)
            out = [
                (mixed(logs[k], own.direct(counts[k]), total / max(1, tokens_of_all), shares[k]) + math.log(1 - own.end)) / math.log(10)
                for k, own in enumerate(classes)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["word"].chunk(0), pa.array(total.astype(np.int64)), *[pa.array(p.astype(np.float32)) for p in out]],
                names=["word", "c", *[f"p{k}" for k in range(n)]],
            )

    return words.mapInArrow(run, "word string, c long, " + ", ".join(f"p{k} float" for k in range(n)))


def score(
    docs: DataFrame,
    vocabulary: str,
    folds: int = FOLDS,
    iterations: int = ITERATIONS,
    chunk_bytes: int = CHUNK_BYTES,
    class_column: str | None = None,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text, perhaps ``class_column``, anything else).

    Returns doc_id, held_out, n_tokens (the end included), n_known (tokens seen in
    training), train_tokens, base_score and score (log10 probabilities). Nothing is
    learned from held-out rows. Null texts count as empty: their only token is the
    end. Repeated rows are scored, and counted, each. Without training rows the
    lattice of the vocabulary's own scores decides alone. A text's own class is never
    looked at when it is scored. ``iterations`` is at least one. An empty table gives an
    empty one.
    """
    keyed, n_chunks, texts = chunked(docs, folds, chunk_bytes, class_column, min_share)
    names = counted(len(texts))
    asked = stored(chunk_words(keyed, n_chunks, len(texts)))
    words = stored(asked.groupBy("word").agg(*[F.sum(n).alias(n) for n in names]))
    total = sum((F.col(n) for n in names), F.lit(0))
    found = words.agg(*[
        f.alias(f"{what}_{n}") for n, c in [*((n, F.col(n)) for n in names), ("all", total)]
        for what, f in (("tokens", F.coalesce(F.sum(c), F.lit(0))), ("types", F.count_if(c > 0)),
                        ("once", F.count_if(c == 1)), ("twice", F.count_if(c == 2)))
    ]).first()
    classes = [
        Counts(t, *(found[f"{what}_{n}"] for what in ("tokens", "types", "once", "twice")))
        for n, t in [*zip(names, texts), ("all", sum(texts))]
    ]
    whole = classes.pop()
    several = [start_weights(vocabulary)] * len(classes)
    shares = [(1.0, 0.0)] * len(classes)
    for _ in range(iterations if whole.types else 0):
        counts, likelihoods = piece_counts(words.where(total > 0), several, classes, whole.tokens)
        several = [
            normalised(w.names, c + SMOOTHING, float(own.types)) if own.types else w
            for w, c, own in zip(several, counts, classes)
        ]
        shares = [best_shares(found) if own.types else (1.0, 0.0) for found, own in zip(likelihoods, classes)]
    scale = math.log10(whole.size + BASE_ADDED * (whole.types + (whole.texts > 0) + 1))
    end_base = math.log10(whole.texts + BASE_ADDED) - scale
    ends = np.array([math.log10(own.end) for own in classes])
    priors = np.log10([(own.texts + 0.5) / (whole.texts + 0.5 * len(classes)) for own in classes])
    lexicon = asked.select("chunk", "word").join(word_logs(words, several, classes, shares, whole.tokens), "word")

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        index = {w: k for k, w in enumerate(known["word"].cast(pa.binary()).to_pylist())}
        c = known["c"].to_numpy().astype(float)
        base = np.log10(c + BASE_ADDED) - scale
        own = np.stack([known[f"p{k}"].to_numpy() for k in range(len(ends))], axis=1).astype(float)
        rows = []
        for data in texts["data"].to_pylist():
            at = np.array([index[w] for w in tokens(data)], np.int64)
            sums = own[at].sum(axis=0) + ends + priors
            top = sums.max()
            value = top + math.log10(np.power(10.0, sums - top).sum())
            rows.append((len(at) + 1, int((c[at] > 0).sum()) + (whole.texts > 0), base[at].sum() + end_base, value))
        columns = list(zip(*rows)) or [[], [], [], []]
        return pa.table({
            "doc_id": texts["doc_id"], "held_out": texts["held_out"],
            "n_tokens": pa.array(columns[0], pa.int64()), "n_known": pa.array(columns[1], pa.int64()),
            "train_tokens": pa.array([whole.size] * len(rows), pa.int64()),
            "base_score": pa.array(columns[2], pa.float64()), "score": pa.array(columns[3], pa.float64()),
        })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    # As many tasks as chunks on both sides, so that a task's share does not grow with the input.
    asking, answers = (side.repartition(n_chunks, "chunk").groupBy("chunk") for side in (keyed.drop("class"), lexicon))
    return asking.cogroup(answers).applyInArrow(run, schema)
