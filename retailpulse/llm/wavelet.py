"""Token ids as one wavelet matrix per shard of consecutive documents.

A shard is a byte image: magic, a header with the sizes of its sections, the
document table (ids, which of them are null, token counts) and one bit-plane per bit
of the ids, highest first, each zstd-compressed. A plane is the ids' bit in the order
left by a stable partition on the bits above, so rank and select on planes answer
access, counting and occurrence queries without restoring the sequence.

Spark writes the images as the rows of Parquet files, one row to a file, through its
own commit protocol: lost tasks leave nothing behind.
"""

from __future__ import annotations

import gc
import json
import os
import re
import string
import struct
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailpulse.llm.common import once_per_worker, shared_folder, slices

MAGIC = b"WMX1"
HEAD = "<4sBIQ"  # magic, planes, documents, tokens
SHARD_TOKENS = 1 << 20
SHARD_SCHEMA = "part int, seq int, n_docs long, n_tokens long, image binary"


class Plane:
    """A bit vector with rank and select."""

    def __init__(self, packed: bytes, n: int):
        self.n = n
        self.packed = np.frombuffer(packed, np.uint8)
        self.zeros = n - int(np.bitwise_count(self.packed).sum(dtype=np.int64))
        self._before = None

    @property
    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed, count=self.n).view(bool)

    @property
    def before(self) -> np.ndarray:
        """Ones before each byte."""
        if self._before is None:
            self._before = np.concatenate([[0], np.bitwise_count(self.packed).cumsum(dtype=np.int64)])
        return self._before

    def bit(self, i: int) -> int:
        return int(self.packed[i >> 3]) >> (7 - (i & 7)) & 1

    def rank1(self, i: int) -> int:
        """Ones among the first ``i`` bits."""
        whole, rest = i >> 3, i & 7
        part = int(self.packed[whole]) >> (8 - rest) if rest else 0
        return int(self.before[whole]) + part.bit_count()

    def rank(self, bit: int, i: int) -> int:
        return self.rank1(i) if bit else i - self.rank1(i)

    def select(self, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) bit of this value."""
        counts = self.before if bit else np.arange(len(self.before)) * 8 - self.before
        byte = int(np.searchsorted(counts, k, side="right")) - 1
        left = k - int(counts[byte])
        for i in range(byte * 8, byte * 8 + 8):
            if self.bit(i) == bit:
                if not left:
                    return i
                left -= 1
        raise IndexError(k)


class WaveletMatrix:
    def __init__(self, planes: list[Plane], n: int):
        self.planes, self.n = planes, n

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        top = int(ids.max()) if len(ids) else 0
        rest = ids.astype(np.uint16 if top < 1 << 16 else np.uint32)
        planes = []
        for shift in reversed(range(max(1, top.bit_length()))):
            ones = (rest >> shift & 1).astype(bool)
            planes.append(Plane(np.packbits(ones).tobytes(), len(rest)))
            # Index lists are several times faster here than masks.
            rest = np.concatenate([rest.take(np.flatnonzero(~ones)), rest.take(np.flatnonzero(ones))])
        return cls(planes, len(rest))

    def tokens(self) -> np.ndarray:
        """The whole sequence, restored from the lowest plane upwards."""
        out = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for shift, plane in enumerate(reversed(self.planes)):
            ones = plane.bits
            whole = np.empty_like(out)
            whole[np.flatnonzero(~ones)] = out[:plane.zeros]
            whole[np.flatnonzero(ones)] = out[plane.zeros:] | out.dtype.type(1 << shift)
            out = whole
        return out

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for plane in self.planes:
            bit = plane.bit(i)
            token = token << 1 | bit
            i = plane.zeros + plane.rank1(i) if bit else i - plane.rank1(i)
        return token

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        for shift, plane in zip(reversed(range(len(self.planes))), self.planes):
            bit = token >> shift & 1
            low, high = (plane.zeros * bit + plane.rank(bit, i) for i in (low, high))
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of ``token`` at positions from ``low`` to before ``high``."""
        if token >> len(self.planes):
            return 0
        start, end = self._range(token, low, self.n if high is None else high)
        return end - start

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of ``token``."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0, self.n)[0] + k
        for shift, plane in enumerate(reversed(self.planes)):
            bit = token >> shift & 1
            i = plane.select(bit, i - plane.zeros * bit)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]


def image(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """The byte image of one shard."""
    matrix = WaveletMatrix.build(ids)
    present = np.array([d is not None for d in doc_ids], bool)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    sections = [numbers.tobytes(), np.packbits(present).tobytes(), np.array(counts, "<u4").tobytes()]
    sections += [p.packed.tobytes() for p in matrix.planes]
    packed = [zstandard.ZstdCompressor(level=1).compress(s) for s in sections]
    head = struct.pack(HEAD, MAGIC, len(matrix.planes), len(doc_ids), len(ids))
    return head + struct.pack(f"<{len(packed)}I", *map(len, packed)) + b"".join(packed)


def opened(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, token counts and wavelet matrix of an image."""
    magic, n_planes, n_docs, n_tokens = struct.unpack_from(HEAD, data)
    if magic != MAGIC:
        raise ValueError("not a wavelet shard")
    sizes = struct.unpack_from(f"<{n_planes + 3}I", data, struct.calcsize(HEAD))
    at, sections = struct.calcsize(HEAD) + 4 * len(sizes), []
    for size in sizes:
        sections.append(zstandard.ZstdDecompressor().decompress(data[at:at + size]))
        at += size
    present = np.unpackbits(np.frombuffer(sections[1], np.uint8), count=n_docs)
    doc_ids = [int(d) if p else None for d, p in zip(np.frombuffer(sections[0], "<i8"), present)]
    matrix = WaveletMatrix([Plane(s, n_tokens) for s in sections[3:]], n_tokens)
    return doc_ids, np.frombuffer(sections[2], "<u4"), matrix


@contextmanager
def without_collector() -> Iterator[None]:
    """No search for reference cycles: none arise here, and a search visits hundreds of thousands of new lists."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Encoder:
    """Token ids of texts as bytes of unsigned 32-bit numbers.

    The vocabulary's splitting never joins what a blank or line feed separates, nor
    letters or digits and punctuation other than an apostrophe, and it lower-cases. So
    texts are cut there, A-Z lower-cased, and the pieces' ids are remembered: those seen
    lately, in two generations of bounded size. Cutting, numbering the pieces of many
    texts and putting their ids together work on whole arrays.
    """

    REMEMBERED = 350_000
    #: Characters that normalising only lower-cases and whose classes all Unicode versions agree on.
    _SIMPLE = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u017f]*")
    _LOWER = bytes.maketrans(string.ascii_uppercase.encode() + b"\n", string.ascii_lowercase.encode() + b" ")
    _ALNUM = np.isin(np.arange(256), list((string.ascii_lowercase + string.digits).encode()))
    _MARKS = np.isin(np.arange(256), list(string.punctuation.replace("'", "").encode()))
    #: Second bytes of the Latin-1 letters after 0xC3: all but those of the signs for times and divided by.
    _LATIN = np.isin(np.arange(256), [c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)])

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lately: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        # The vocabulary alone, for words that are already split as the tokenizer does.
        self.model = Tokenizer(self.tokenizer.model)
        made = json.loads(self.tokenizer.to_str())
        steps = [s["type"] for s in made["normalizer"]["normalizers"] + made["pre_tokenizer"]["pretokenizers"]]
        if steps != ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]:
            raise ValueError(f"a tokenizer of other steps is expected: {steps}")
        self.splits = regex.compile(made["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        by_byte = self.tokenizer.pre_tokenizer[1]
        simple = [chr(c) for c in range(0x21, 0x180) if self._SIMPLE.fullmatch(chr(c))]
        suffix = made["model"]["end_of_word_suffix"]
        if not suffix:
            raise ValueError("a vocabulary that marks the ends of words is expected")
        ends = [token_id for token, token_id in made["model"]["vocab"].items() if token.endswith(suffix)]
        self.ends_word = np.zeros(max(made["model"]["vocab"].values()) + 1, bool)
        self.ends_word[ends] = True
        self.bytes_shown = {ord(c): by_byte.pre_tokenize_str(c)[0][0] for c in simple}

    def _whole(self, words: list[str]) -> list[bytes]:
        """Each word on its own through the whole tokenizer; one call takes many as the words of one text."""
        out = [b""] * len(words)
        for start in range(0, len(words), 2000):
            found = self.tokenizer.encode(words[start:start + 2000], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            owners = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(owners)) + 1).tolist(), len(owners)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    out[start + int(owners[a])] = ids[4 * a:4 * b]
        return out

    def _ids(self, words: list[str]) -> list[bytes]:
        """Each word by the vocabulary alone; its last id is one that ends words, which tells the words of a call apart."""
        out = []
        for start in range(0, len(words), 2000):
            some = words[start:start + 2000]
            (found,) = self.model.encode_batch_fast([some], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            data, ends = ids.tobytes(), ((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()
            if len(ends) != len(some):
                raise ValueError("the vocabulary does not end every word once")
            out += [data[a:b] for a, b in zip([0, *ends], ends)]
        return out

    def _split(self, word: str) -> list[str]:
        """Parts of a simple lower-case piece; letters, also with punctuation after them, need no expression."""
        if word.isalpha():
            return [word]
        letters = word.rstrip(string.punctuation)
        if letters.isalpha():
            return [letters, word[len(letters):]]
        return self.splits.findall(word)

    def _encoded(self, pieces: list[bytes]) -> list[bytes]:
        """Simple pieces are split here and their parts looked up in the vocabulary, others go through the whole tokenizer."""
        words = [p.decode() for p in pieces]
        parts = [
            [w] if w.isascii() and w.isalpha() else self._split(w.lower()) if self._SIMPLE.fullmatch(w) is not None else None
            for w in words
        ]
        new = list(dict.fromkeys(part for some in parts if some for part in some))
        shown = [part if part.isascii() else part.translate(self.bytes_shown) for part in new]
        known = dict(zip(new, self._ids(shown)))
        rest = iter(self._whole([w for w, some in zip(words, parts) if some is None]))
        return [
            next(rest) if some is None else known[some[0]] if len(some) == 1 else b"".join([known[part] for part in some])
            for some in parts
        ]

    def _cut(self, texts: list[str]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """The pieces of all texts, without the blanks between them, and how many there are up to each text's end."""
        data = [t.encode() for t in texts]
        whole = b" ".join([*data, b""]).translate(self._LOWER)
        chars = np.frombuffer(whole, np.uint8)
        blank, marks, joins = chars == 0x20, self._MARKS[chars], self._ALNUM[chars]
        ends = blank.copy()
        ends[1:] |= marks[:-1] & joins[1:]
        joins[1:] |= self._LATIN[chars[1:]] & (chars[:-1] == 0xC3)
        ends[1:] |= joins[:-1] & marks[1:]
        at = np.flatnonzero(ends)
        blanks = blank[at].cumsum() - blank[at]
        offsets = pa.py_buffer(np.concatenate([[0], at - blanks]))
        letters = pa.py_buffer(whole.translate(None, b" "))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, offsets, letters])
        lasts = np.cumsum([len(d) + 1 for d in data], dtype=np.int64) - 1
        return pieces, np.searchsorted(at, lasts, side="right")

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        # A text with the start of a special token is left to the tokenizer: that is told apart by case.
        special = ["<|" in t for t in texts]
        pieces, counts = self._cut(["" if s else t for t, s in zip(texts, special)])
        numbered = pieces.dictionary_encode()
        with without_collector():
            known = self._looked_up(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(known, pa.large_binary()).take(numbered.indices)
        bounds = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)
        ends, data = bounds[counts].tolist(), memoryview(ids.buffers()[2] or b"")
        for text, left, start, end in zip(texts, special, [0, *ends], ends):
            if left:
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                yield bytes(data[start:end])

    def _looked_up(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of different pieces, which are remembered."""
        known = list(map(self.lately.get, pieces))
        unseen = [k for k, ids in enumerate(known) if ids is None]
        before = [self.before.get(pieces[k]) for k in unseen]
        new = iter(self._encoded([pieces[k] for k, ids in zip(unseen, before) if ids is None]))
        for k, ids in zip(unseen, before):
            self.lately[pieces[k]] = known[k] = next(new) if ids is None else ids
        if len(self.lately) > self.REMEMBERED:
            self.before, self.lately = self.lately, {}
        return known


def write_shards(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode ``docs`` (doc_id, text, anything else) and write shards in ascending doc_id order.

    Null texts count as empty; every document ends with ``end_id``. Null ids come
    first, rows of one id follow each other in the order of a hash of their text. A
    shard is closed once it holds ``shard_tokens`` tokens; a document is never cut.
    An empty table writes a folder without shards.
    """
    def run(batches):
        encoder = once_per_worker(("encoder", tokenizer), lambda: Encoder(tokenizer))
        end = np.array([end_id], "<u4").tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, parts, held = [], [], 0

        def shard():
            data = image(doc_ids, [len(p) // 4 for p in parts], np.frombuffer(b"".join(parts), "<u4"))
            values = ([part], [seq], [len(parts)], [held], [data])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], names=["part", "seq", "n_docs", "n_tokens", "image"]
            )

        for batch in batches:
            numbers = iter(batch["doc_id"].to_pylist())
            for some in slices(batch["text"].to_pylist(), 4_000_000):
                for ids in encoder.encode(some):
                    doc_ids.append(next(numbers))
                    parts.append(ids + end)
                    held += len(parts[-1]) // 4
                    if held >= shard_tokens:
                        yield shard()
                        doc_ids, parts, held, seq = [], [], 0, seq + 1
        if parts:
            yield shard()

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = chosen.withColumn("mark", F.xxhash64("text"))
    ordered = chosen.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark")
    shards = ordered.mapInArrow(run, SHARD_SCHEMA)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``folder``.

    start counts the tokens of all documents before it; the checksum is over the ids
    as little-endian unsigned 32-bit numbers.
    """
    def run(batches):
        for batch in batches:
            for part, seq, data in zip(batch["part"].to_pylist(), batch["seq"].to_pylist(), batch["image"]):
                doc_ids, counts, matrix = opened(data.as_py())
                ids = matrix.tokens().astype("<u4")
                ends = counts.cumsum(dtype=np.int64)
                starts = ends - counts
                sums = [zlib.crc32(ids[s:e].data) for s, e in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(sums), pa.int32()), pa.array([seq] * len(sums), pa.int32()),
                    pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(counts.astype(np.int64)),
                    pa.array(sums, pa.int64()),
                ], names=["part", "seq", "doc_id", "within", "n_tokens", "ids_crc32"])

    shards = spark.read.schema(SHARD_SCHEMA).parquet(folder)
    found = shards.select("part", "seq", "image").mapInArrow(
        run, "part int, seq int, doc_id long, within long, n_tokens long, ids_crc32 long"
    )
    sizes = shards.select("part", "seq", "n_tokens")
    # Tokens before a part: one row per part, as many as the writing job had tasks.
    of_parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    ordered = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_parts = of_parts.select("part", F.coalesce(F.sum("size").over(ordered), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("shard_start"))
    offsets = offsets.join(of_parts, "part").select("part", "seq", (F.col("part_start") + F.col("shard_start")).alias("base"))
    joined = found.join(offsets, ["part", "seq"])
    return joined.select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` as shards and return what the files hold."""
    folder = folder or shared_folder(docs.sparkSession)
    write_shards(docs, tokenizer, folder, **options)
    return read_shards(docs.sparkSession, folder)
