"""SentencePiece encoding as the shortest path of a weighted transducer, and decoding.

The transducer is the composition of three machines. The normaliser inserts a word
mark before the text and rewrites blanks to it. The piece machine is a trie whose
accepted strings emit a piece with weight minus its score. Byte fallback gives each
character without a piece an arc that emits its UTF-8 bytes. The states also hold the
last piece: a merge-based vocabulary accepts two neighbours only if merging their
joined characters leaves just these two, and a sequence of which all neighbours are
accepted is the result of the merges. Other (unigram) vocabularies accept all
neighbours. The shortest path is taken in the tropical semiring (minimum, plus).
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from retailpulse.llm.common import once_per_worker, slices
from retailpulse.llm.lattice_lm import Lattice

MARK = "▁"
#: Characters that are encoded at a time.
SLICE = 2_000_000


class Decoder:
    """Texts of ids: the transducer read backwards."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        # What each id decodes to; control pieces decode to nothing.
        self.surface = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.surface.append(b"")
            else:
                self.surface.append(piece.replace(MARK, " ").encode())

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``: bytes joined, word marks as blanks, the leading one removed."""
        text = b"".join([self.surface[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class Transducer(Decoder):
    #: Encoded chunks of a generation, and accepted neighbours, that are remembered at most.
    REMEMBERED = 150_000
    #: Characters of a chunk that is remembered, so that the bytes held are bounded, too.
    SHORT = 64

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        super().__init__(path)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        if proto.normalizer_spec.name != "identity" or not proto.normalizer_spec.add_dummy_prefix:
            raise ValueError("only identity normalisation with a leading word mark is supported")
        if proto.normalizer_spec.remove_extra_whitespaces or not proto.trainer_spec.byte_fallback:
            raise ValueError("only vocabularies that keep white space and have byte fallback are supported")
        self.by_merges = proto.trainer_spec.model_type == 2
        n = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)]
        self.pieces = {model.id_to_piece(i): (i, -model.get_score(i)) for i in range(n) if not special[i]}
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("pieces must hold word marks at their start only")
        self.longest = max(map(len, self.pieces))
        self.prefixes = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}
        byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_ids = [byte_ids[b] for b in range(256)]
        self.byte_weight = 0.0 if self.by_merges else -min(model.get_score(i) for i in self.byte_ids)
        # Whether a text is a piece (True) or only the start of one (False).
        self.lookup = {p: p in self.pieces for p in self.prefixes}
        self.packed = {p: np.array([i], "<i4").tobytes() for p, (i, _) in self.pieces.items()}
        self.accepted: dict[str, dict[str, bool]] = {}
        self.decided = 0
        # For whole arrays of chunks: the lattice over piece numbers, and the decided pairs in order.
        self.names = list(self.pieces)
        self.characters = {c for c in self.pieces if len(c) == 1} - {MARK} | {" "}
        self.ids = np.array([self.pieces[p][0] for p in self.names], "<i4")
        self.lengths = np.array(list(map(len, self.names)))
        self.in_arrays = self.by_merges and all(c in self.pieces for p in self.pieces for c in p)
        self.lattice = Lattice(self.names) if self.in_arrays else None
        self.pairs = np.array([np.iinfo(np.int64).max])
        self.fitting = np.array([False])
        self.steps: dict[str, list[tuple[float, str, str]] | None] = {}
        # Chunks seen lately and before that, with their ids.
        self.lately: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def history(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """Repeated merging of the characters, best score first, then leftmost.

        Returns what is left, and after every merge its weight with the last and the
        first part, the characters' own first.
        """
        parts = list(text)
        steps = [(-math.inf, parts[-1], parts[0])]
        while True:
            joined = [(self.pieces[p][1], k) for k in range(len(parts) - 1) if (p := parts[k] + parts[k + 1]) in self.pieces]
            if not joined:
                return parts, steps
            weight, k = min(joined)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            steps.append((weight, parts[-1], parts[0]))

    def steps_of(self, piece: str) -> list[tuple[float, str, str]] | None:
        """The merges that make ``piece`` from its characters; None if merging ends otherwise."""
        if piece not in self.steps:
            left, steps = self.history(piece)
            self.steps[piece] = steps if len(left) == 1 else None
        return self.steps[piece]

    def accepts(self, left: str, right: str) -> bool:
        """Whether merging the joined characters of two pieces leaves just these two.

        The merges within either piece run in the order they have there; the pair is
        refused if a merge across the border comes first at any time.
        """
        a, b = self.steps_of(left), self.steps_of(right)
        if a is None or b is None:
            return False
        i = j = 0
        found = True
        while found:
            across = self.pieces.get(a[i][1] + b[j][2])
            next_a = a[i + 1][0] if i + 1 < len(a) else math.inf
            next_b = b[j + 1][0] if j + 1 < len(b) else math.inf
            # Of equal merges the leftmost comes first.
            if across is not None and across[1] < next_a and across[1] <= next_b:
                found = False
            elif next_a == next_b == math.inf:
                break
            elif next_a <= next_b:
                i += 1
            else:
                j += 1
        return found

    def arcs(self, text: str) -> list[list[tuple[int, str, float]]]:
        """For each end, the arcs (start, piece, weight) of the lattice, longest first."""
        ends: list[list[tuple[int, str, float]]] = [[] for _ in range(len(text) + 1)]
        pieces, prefixes = self.pieces, self.prefixes
        for start in range(len(text)):
            for end in range(start + 1, min(len(text), start + self.longest) + 1):
                piece = text[start:end]
                if piece not in prefixes:
                    break
                if piece in pieces:
                    ends[end].append((start, piece, pieces[piece][1]))
            if text[start] not in pieces:
                ends[start + 1].append((start, text[start], self.byte_weight))
        return ends

    def shortest_path(self, text: str) -> list[str]:
        """The pieces on the lightest path through normalised ``text``."""
        if self.by_merges:
            return self._only_path(text)
        best: list[tuple[float, int, str] | None] = [None] * (len(text) + 1)
        best[0] = (0.0, 0, "")
        for end, arcs in enumerate(self.arcs(text)):
            for start, piece, weight in arcs:
                if best[end] is None or best[start][0] + weight < best[end][0]:
                    best[end] = (best[start][0] + weight, start, piece)
        end, path = len(text), []
        while end:
            _, end, piece = best[end]
            path.append(piece)
        return path[::-1]

    def _only_path(self, text: str) -> list[str]:
        """The same for merge-based vocabularies.

        Merging has one result, so of the paths to a position one alone is accepted,
        and the search may leave a position once it has found it.
        """
        size, found, accepted = len(text), self.lookup.get, self.accepted
        last: list[str | None] = [None] * (size + 1)
        last[0] = ""
        for start in range(size):
            left = last[start]
            if left is None:
                continue
            after = accepted.setdefault(left, {})
            for end in range(start + 1, min(size, start + self.longest) + 1):
                piece = text[start:end]
                state = found(piece)
                if state is None and end > start + 1:
                    break
                # A character without a piece has its byte arc.
                if last[end] is None and (state or end == start + 1):
                    fits = after.get(piece)
                    if fits is None:
                        self.decided += 1
                        fits = after[piece] = self.accepts(left, piece) if left else self.steps_of(piece) is not None
                    if fits:
                        last[end] = piece
        path, end = [], size
        while end:
            path.append(last[end])
            end -= len(last[end])
        return path[::-1]

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``accepts`` of pairs of piece numbers; the left one is -1 at the start of a chunk."""
        keys = (left.astype(np.int64) + 1) * len(self.names) + right
        at = np.searchsorted(self.pairs, keys)
        new = np.unique(keys[self.pairs[at] != keys])
        if len(new):
            if len(self.pairs) > 10 * self.REMEMBERED:
                self.pairs, self.fitting = self.pairs[-1:], self.fitting[-1:]
                new = np.unique(keys)
            found = []
            for key in new.tolist():
                before, piece = key // len(self.names) - 1, self.names[key % len(self.names)]
                alone = self.steps_of(piece) is not None
                found.append(alone and (before < 0 or self.accepts(self.names[before], piece)))
            order = np.searchsorted(self.pairs, new)
            self.pairs, self.fitting = np.insert(self.pairs, order, new), np.insert(self.fitting, order, found)
            at = np.searchsorted(self.pairs, keys)
        return self.fitting[at]

    def _paths(self, chunks: list[str]) -> list[bytes]:
        """Ids of equally long chunks, all of whose characters are pieces."""
        n, size = len(chunks), len(chunks[0])
        cells = self.lattice.cells(chunks)[1]
        last = np.full((size + 1, n), -2, np.int64)
        last[0] = -1
        for end in range(1, size + 1):
            for start in range(max(0, end - self.longest), end):
                numbers = cells.get((start, end))
                if numbers is None:
                    continue
                rows = np.flatnonzero((last[end] == -2) & (numbers >= 0) & (last[start] > -2))
                rows = rows[self._fit(last[start, rows], numbers[rows])]
                last[end, rows] = numbers[rows]
        path = np.full((n, size), -1, np.int64)
        at, column, rows = np.full(n, size), size, np.arange(n)
        while len(rows):
            column -= 1
            path[rows, column] = last[at[rows], rows]
            at[rows] -= self.lengths[path[rows, column]]
            rows = rows[at[rows] > 0]
        used = path >= 0
        flat, ends = self.ids[path[used]].tobytes(), used.sum(axis=1).cumsum().tolist()
        return [flat[4 * a:4 * b] for a, b in zip([0, *ends], ends)]

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of ``chunks`` (blanks for word marks)."""
        found: dict[str, bytes] = {}
        groups: dict[int, list[str]] = {}
        for chunk in chunks:
            if self.in_arrays and len(chunk) <= self.SHORT and self.characters.issuperset(chunk):
                groups.setdefault(len(chunk), []).append(chunk)
            else:
                found[chunk] = self.emitted(self.shortest_path(chunk.replace(" ", MARK)))
        for group in groups.values():
            for part in range(0, len(group), 20_000):
                some = group[part:part + 20_000]
                found.update(zip(some, self._paths([c.replace(" ", MARK) for c in some])))
        return found

    def emitted(self, path: list[str]) -> bytes:
        """Ids of a path, bytes for characters without a piece."""
        return b"".join([
            self.packed[p] if p in self.packed else np.array([self.byte_ids[b] for b in p.encode()], "<i4").tobytes()
            for p in path
        ])

    # Chunks that no piece crosses: blanks with what follows them, and line feeds.
    _CHUNKS = re.compile(r" +[^ \n]*|\n+|[^ \n]+")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes of little-endian signed 32-bit numbers; none for an empty text.

        A path through a text is a path through its chunks, for no piece holds a word
        mark behind another character. Vocabularies with pieces across line feeds or
        without merges are searched text by text.
        """
        whole = not self.by_merges or "\n" in self.prefixes
        marked = [" " + t.replace(MARK, " ") if t else "" for t in texts]
        cut = [[t] if whole and t else self._CHUNKS.findall(t) for t in marked]
        here = dict.fromkeys(set().union(*cut))
        new = []
        for chunk in here:
            known = self.lately.get(chunk)
            if known is None:
                known = self.before.get(chunk)
                if known is None:
                    new.append(chunk)
                    continue
                self.lately[chunk] = known
            here[chunk] = known
        found = self.learn(new)
        here.update(found)
        self.lately.update((chunk, ids) for chunk, ids in found.items() if len(chunk) <= self.SHORT)
        if len(self.lately) > self.REMEMBERED:
            self.before, self.lately = self.lately, {}
        if self.decided > 2 * self.REMEMBERED or len(self.steps) > self.REMEMBERED:
            self.decided = 0
            self.accepted.clear()
            self.steps.clear()
        return [b"".join(map(here.__getitem__, chunks)) for chunks in cut]


def encode(docs: DataFrame, model: str, column: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with ``out`` (array<int>), the ids of ``column``.

    Null texts count as empty and give an empty array. A column already named
    ``out`` is replaced; all others are kept, repeated rows too.
    """
    kept = [c for c in docs.columns if c != out]
    schema = StructType([docs.schema[c] for c in kept] + [StructField(out, ArrayType(IntegerType(), False), True)])

    def run(batches):
        machine = once_per_worker(("transducer", model), lambda: Transducer(model))
        for batch in batches:
            at = 0
            # Many texts at a time, for long arrays of new chunks.
            for texts in slices([t or "" for t in batch.column(column).to_pylist()], SLICE):
                part = batch.slice(at, len(texts))
                at += len(texts)
                coded = machine.encode(texts)
                ends = np.cumsum([0] + [len(c) // 4 for c in coded])
                values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [ids], names=[*kept, out])

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with ``out`` (string), the text of the ids in ``column``; null for null."""
    kept = [c for c in encoded.columns if c != out]
    schema = StructType([encoded.schema[c] for c in kept]).add(out, "string")

    def run(batches):
        machine = once_per_worker(("decoder", model), lambda: Decoder(model))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [None if ids is None else machine.decode(ids) for ids in part.column(column).to_pylist()]
                arrays = [part.column(c) for c in kept] + [pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, out])

    return encoded.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def digest(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, decoded_crc32, round_trip) of ``docs`` (doc_id, text), encoded and decoded.

    Checksums are unsigned; that of the ids is over little-endian 32-bit numbers.
    round_trip tells whether the decoded text is the given one, null counting as empty
    and word marks as blanks.
    """
    def run(batches):
        machine = once_per_worker(("transducer", model), lambda: Transducer(model))
        for batch in batches:
            at = 0
            # One worker does all three: texts, ids and decoded texts of a slice at a time.
            for texts in slices([t or "" for t in batch.column("text").to_pylist()], SLICE):
                found = []
                for text, raw in zip(texts, machine.encode(texts)):
                    decoded = machine.decode(np.frombuffer(raw, "<i4").tolist())
                    found.append((len(raw) // 4, zlib.crc32(raw), zlib.crc32(decoded.encode()), decoded == text.replace(MARK, " ")))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
                columns = [pa.array(values, kind) for values, kind in zip(zip(*found), kinds)]
                ids = batch.column("doc_id").slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "n_ids", "ids_crc32", "decoded_crc32", "round_trip"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, decoded_crc32 long, round_trip boolean")
