import gc
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from odd import EXTRA, frame, odd_texts
from retailpulse.llm import piece_transducer, wavelet
from retailpulse.llm.piece_transducer import Transducer

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (7, 3), (1000, 2), (5000, 49_407), (3000, 70_000)])
def test_wavelet_matrix_answers_like_the_sequence(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype("<u4")
    data = wavelet.image([5, None], [n, 0], ids)
    doc_ids, counts, matrix = wavelet.opened(data)
    assert doc_ids == [5, None] and counts.tolist() == [n, 0]
    assert np.array_equal(matrix.tokens(), ids)
    for i in range(0, n, max(1, n // 20)):
        token = int(ids[i])
        assert matrix.access(i) == token
        assert matrix.count(token) == (ids == token).sum()
        assert matrix.count(token, i, n) == (ids[i:] == token).sum()
        assert matrix.select(token, int((ids[:i] == token).sum())) == i
    if n:
        assert matrix.occurrences(int(ids[0]))[:50] == np.flatnonzero(ids == ids[0])[:50].tolist()
        assert matrix.count(1 << 20) == 0
        with pytest.raises(IndexError):
            matrix.access(n)


def test_shards_hold_what_the_tokenizer_gives(spark, tmp_path):
    rows = odd_texts()
    docs = frame(spark, rows).repartition(3)
    found = wavelet.round_trip(docs, WORDS, f"file://{tmp_path}/shards", shard_tokens=500).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    want, start = [], 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for _, group in __import__("itertools").groupby(ordered, key=lambda r: r[0]):
        for doc_id, text in group:
            ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
            want.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    got = sorted([(r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in found])
    for at, doc_id, n, _ in got:
        assert at == start
        start += n
    assert sorted([g[1:] for g in got], key=repr) == sorted(want, key=repr)
    assert [g[1] for g in got] == [w[0] for w in want]


def test_shards_of_an_empty_table(spark, tmp_path):
    empty = frame(spark, [])
    assert wavelet.round_trip(empty, WORDS, f"file://{tmp_path}/none").count() == 0


def random_texts(n=150):
    rng = np.random.default_rng(7)
    letters = list("abcdefghinorstu éß東𝒳.,'19 \n") + ["the ", "tion", "  ", "\u2581"]
    return ["".join(rng.choice(letters, 120)) for _ in range(n)]


def test_shortest_paths_are_the_librarys_encoding():
    machine, library = Transducer(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t or "" for _, t in odd_texts()] + random_texts() + ["▁▁ x", " " * 40 + "x", "\n", "<0x0A>", "in" * 60]
    for text, data in zip(texts, machine.encode(texts)):
        ids = np.frombuffer(data, "<i4").tolist()
        assert ids == library.encode(text), text[:80]
        assert machine.decode(ids) == library.decode(ids)


def test_array_and_single_search_agree():
    machine = Transducer(PIECES)
    chunks = ["▁heretofore", "▁unbelieva", "▁xylophone,", "▁!!!!", "▁▁▁"]
    for chunk in chunks:
        assert machine._paths([chunk])[0] == machine.emitted(machine.shortest_path(chunk))


def test_encode_and_decode_keep_rows_and_columns(spark):
    rows = odd_texts()
    docs = frame(spark, rows)
    coded = piece_transducer.decode(piece_transducer.encode(docs, PIECES), PIECES)
    assert coded.columns == [c for c in docs.columns if c != "ids"] + ["ids", "decoded"]
    found = coded.select("doc_id", "decoded", "word").collect()
    assert sorted([(r.doc_id, r.decoded) for r in found], key=repr) == sorted([(i, t or "") for i, t in rows], key=repr)
    assert {r.word for r in found} == {"own word"}
    assert all(r.round_trip for r in piece_transducer.digest(docs, PIECES).collect())
    assert piece_transducer.digest(frame(spark, []), PIECES).count() == 0
    assert set(EXTRA) <= set(coded.columns)


def test_ids_are_the_librarys_for_any_characters():
    whole, rng = Tokenizer.from_file(WORDS), random.Random(1)
    letters = [chr(c) for c in [*range(0x20, 0x250), 0x300, 0x301, 0x3A3, 0x3C2, 0x2019, 0x4E00, 0x1F600]]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["İ", "ß'S don't I'LL x's_'re ŉ ĸ", "a\xadb\xa0c", "'s's'T", "tab\tand\nline", "<|endoftext|> x", ""]
    encoder = wavelet.Encoder(WORDS)
    encoder.REMEMBERED = 500
    for some in (texts[:700], texts[700:], texts):
        want = [whole.encode(t, add_special_tokens=False).ids for t in some]
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(some)] == want


def test_simple_pieces_are_split_as_the_expression_does():
    """Every simple character alone, among letters and before them; the collector is on again afterwards."""
    encoder, rng = wavelet.Encoder(WORDS), random.Random(3)
    simple = [chr(c) for c in range(0x21, 0x180) if encoder._SIMPLE.fullmatch(chr(c))]
    pieces = [p for c in simple for p in (c, f"ab{c}", f"{c}ab", f"ab{c}{c}", f"ab{c}é")]
    pieces += ["".join(rng.choice(simple + list("abc.,'")) for _ in range(rng.randrange(1, 9))) for _ in range(5000)]
    assert all(encoder._split(p.lower()) == encoder.splits.findall(p.lower()) for p in pieces)
    words = [p.lower().translate(encoder.bytes_shown) for p in pieces[:4500]]
    want = [encoder.model.encode([w], is_pretokenized=True, add_special_tokens=False).ids for w in words]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder._ids(words)] == want
    list(encoder.encode(["some text"]))
    assert gc.isenabled()


def test_words_are_looked_up_once_whatever_marks_stand_around_them():
    """Cutting at marks before the look-up: fewer pieces than words with their marks, and the library's ids."""
    encoder, seen = wavelet.Encoder(WORDS), []
    inner = encoder._encoded
    encoder._encoded = lambda pieces: seen.extend(pieces) or inner(pieces)
    texts = ["River, (river) river.\nRIVER; été! «été», été", "river:bank/river don't, <river", "", "river <|endoftext|>", "a.'s b×, 5÷, ß"]
    want = [Tokenizer.from_file(WORDS).encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == want
    assert [p for p in seen if b"river" in p] == [b"river"]
    assert len(seen) == len(set(seen)) and b"don't" in seen
    assert list(encoder.encode(texts)) == list(encoder.encode(texts)) and list(encoder.encode([])) == []


def test_marks_and_letters_of_all_kinds_side_by_side():
    whole, rng, encoder = Tokenizer.from_file(WORDS), random.Random(11), wavelet.Encoder(WORDS)
    encoder.REMEMBERED = 500
    letters = "abé's ,.!×÷İßÀ5²<>≠̸́̇Å'\"tRlLmMdDvVeE\n|_ªº\x00\x85　東"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(25))) for _ in range(4000)]
    for some in (texts[:2000], texts[2000:], texts):
        want = [whole.encode(t, add_special_tokens=False).ids for t in some]
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(some)] == want
