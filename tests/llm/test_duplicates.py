import importlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from odd import EXTRA, SENTENCE, frame, odd_texts
from retailpulse.llm import cross_polytope, decontamination, graph, line_chunks, simhash_pivots
from retailpulse.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def component_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_cycles(spark):
    rng = np.random.default_rng(3)
    links = [(k, k + 1) for k in range(100, 140)] + [(500, k) for k in range(501, 530)] + [(1, 2), (2, 3), (3, 1), (7, 7)]
    links += [tuple(map(int, rng.integers(1000, 1100, 2))) for _ in range(60)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    found = dict(graph.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == component_of(nodes, [p for p in links if p[0] != p[1]])
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    pieces = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_follow_their_definition():
    for _, text in odd_texts():
        if len(text or "") < 10_000:
            assert simhash_pivots.fingerprint((text or "").encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("part_rows", [5, 4096])
def test_every_close_pair_is_linked_through_pivots(spark, part_rows):
    rng = np.random.default_rng(1)
    fps = set()
    for center in rng.integers(0, 1 << 62, 25).tolist():
        for _ in range(12):
            for bit in rng.integers(0, 64, int(rng.integers(1, 4))).tolist():
                center ^= 1 << bit
            fps.add(center)
    fps = np.array(sorted(fps), np.uint64).view(np.int64)
    links = [(int(fps[i]), int(fps[j])) for i in range(len(fps)) for j in range(i)
             if np.bitwise_count(fps[i].view(np.uint64) ^ fps[j].view(np.uint64)) <= 3]
    keyed = simhash_pivots.keyed(spark.createDataFrame([(int(f),) for f in fps], "fp long"))
    found = simhash_pivots.bucket_links(simhash_pivots.in_parts(keyed, part_rows), 3).collect()
    assert component_of(fps.tolist(), [(r.a, r.b) for r in found]) == component_of(fps.tolist(), links)


def test_near_duplicates_of_odd_rows(spark):
    rows = odd_texts()
    found = simhash_pivots.near_duplicates(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    group = defaultdict(set)
    for r in found:
        group[r.component_id].add(r.doc_id)
    assert group[3] == {3, 4, 5, 10, None} and {1, 2, 11} <= group[1]
    kept = simhash_pivots.one_of_each(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 1 and ids.count(1) == 1 and 2 not in ids and 4 not in ids
    assert simhash_pivots.near_duplicates(frame(spark, [])).count() == 0
    assert simhash_pivots.one_of_each(frame(spark, [])).count() == 0
    twice = frame(spark, [(5, "same text here now")] * 3 + [(5, "another text of words")])
    assert sorted(r.text for r in simhash_pivots.one_of_each(twice).collect()) == ["another text of words", "same text here now"]


def test_op9_against_all_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    fps = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    want = component_of(fps, links)
    found = QUERIES["op9_simhash_pivots"](spark, DATA).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {k: (f"{fps[k]:016x}", want[k]) for k in fps}


PASSAGE = "\n".join(f"passage line {k} with its own words " + " ".join(f"w{k}{j}" for j in range(20)) for k in range(4))
LONG_LINE = " ".join(f"long{k}" for k in range(60))


def body(name, n=4):
    return [f"{name} line {k} " + " ".join(f"{name}{k}{j}" for j in range(8)) for k in range(n)]


def test_shared_passages_go_and_other_lines_stay(spark):
    a, b, c, d = (body(x) for x in ("ada", "bob", "cyd", "dan"))
    rows = [
        (1, "\n".join(a[:2] + [PASSAGE] + a[2:])), (2, "\n".join([PASSAGE] + b)), (3, "\n".join(c + [PASSAGE])),
        (4, "\n".join(d[:1] + [LONG_LINE] + d[1:])), (5, "\n".join(a[:1] + b[:0] + ["eve"] + [LONG_LINE])),
        (6, "\n".join(a[:2] + [PASSAGE] + a[2:])), (7, "single\nshared line"), (8, "other\nshared line"),
    ]
    found = {r.doc_id: (r.text, r.n_removed) for r in line_chunks.without_repeats(frame(spark, rows)).collect()}
    assert found[1] == (rows[0][1], 0)
    assert found[2] == ("\n".join(b), 4) and found[3] == ("\n".join(c), 4)
    assert found[4][1] == 0 and found[5][0] == "\n".join(a[:1] + ["eve"]) and found[5][1] == 1
    assert found[6] == ("", 8)
    assert found[7][1] == 0 and found[8][1] == 0


def test_no_line_is_lost_from_the_corpus_and_columns_stay(spark):
    rows = odd_texts() + [(20 + k, "\n".join(body("x", 3) + body(f"y{k}", 2) + [""])) for k in range(5)]
    docs = frame(spark, rows)
    found = line_chunks.without_repeats(docs)
    assert found.columns == [c for c in docs.columns if c != "n_removed"] + ["n_removed"]
    got = found.collect()
    assert len(got) == len(rows)
    assert sum(r.text is None for r in got) == sum(t is None for _, t in rows)
    before = {line for _, t in rows for line in (t or "").split("\n")}
    assert before == {line for r in got for line in (r.text or "").split("\n")} | {""}
    assert line_chunks.without_repeats(frame(spark, [])).count() == 0


def test_equal_hashes_of_other_lines_are_told_apart(spark):
    docs = frame(spark, [(1, "one\ntwo"), (2, "one\nother")], extra=False)
    place = "struct<absent:boolean,_id:long,_mark:long,s:int>"
    marks = {r["_id"]: r["_mark"] for r in line_chunks.marked(docs).collect()}
    segments = spark.createDataFrame([(2, marks[2], 0, 2, (False, 1, marks[1], 0))], f"_id long, _mark long, s int, n int, of {place}")
    assert [tuple(r) for r in line_chunks.compared(docs, segments).collect()] == [(2, marks[2], 0)]


def shingles(text):
    words = (text or "").encode().lower().split()
    return [b" ".join(words[k:k + 5]) for k in range(max(1, len(words) - 4))] if words else []


def leaked(text, item):
    own, want = shingles(text), shingles(item)
    if not want:
        return False
    for start in range(max(1, len(own))):
        part, whole = Counter(own[start:start + len(want)]), Counter(want)
        shared = sum((part & whole).values())
        if shared and shared / (sum(part.values()) + len(want) - shared) >= 0.8:
            return True
    return False


def test_op6_against_every_window(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    items = spark.read.parquet(f"{DATA}/benchmark.parquet").collect()
    known = {s for i in items for s in shingles(i.text)}
    want = {d.doc_id: sorted(i.item_id for i in items if leaked(d.text, i.text)) if known.intersection(shingles(d.text)) else [] for d in docs}
    found = QUERIES["op6_decontamination"](spark, DATA).collect()
    assert {r.doc_id: r["items"] for r in found} == {k: ",".join(map(str, v)) for k, v in want.items()}
    assert any(want.values())


def test_altered_passages_and_odd_rows(spark):
    item = " ".join(f"w{k}" for k in range(60))
    words = item.split()
    changed = words[:]
    changed[30] = "other"
    half = " ".join(words[:30])
    rows = odd_texts() + [
        (100, "before it " + item + " and after"), (101, "x y " + " ".join(changed) + " z"), (102, "a b " + half + " c d"),
        (103, " ".join(words[:20] + ["new"] + words[20:])), (104, item), (104, item), (105, "tiny item"),
    ]
    items = frame(spark, [(1, item), (2, None), (3, ""), (None, "of null id " + item[::-1]), (4, "tiny item"), (1, item)], schema="item_id long, text string")
    docs = frame(spark, rows).drop("items")
    found = decontamination.judged(docs, items)
    assert found.columns == [*docs.columns, "items"]
    got = sorted(((r.doc_id, r["items"]) for r in found.collect() if r["items"]), key=repr)
    assert got == [(100, [1]), (101, [1]), (103, [1]), (104, [1]), (104, [1]), (105, [4])]
    assert found.count() == len(rows)
    assert decontamination.judged(docs.limit(0), items).count() == 0
    assert not any(r["items"] for r in decontamination.judged(docs, items.limit(0)).collect())


def embedding_rows():
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(30):
        center = rng.normal(size=32)
        rows += [(center + rng.normal(size=32) * s).astype(np.float32).tolist() for s in (0, 0.05, 0.15, 0.3)]
    rows += [rows[0], rows[0], [2 * x for x in rows[4]]]
    return [(k, v) for k, v in enumerate(rows)]


@pytest.mark.parametrize("part_rows", [6, 2048])
def test_links_of_embeddings_against_all_pairs(spark, part_rows):
    rows = embedding_rows()
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    vectors = frame(spark, rows, schema="vec_id long, embedding array<float>")
    found = cross_polytope.near_duplicates(vectors, part_rows=part_rows).collect()
    got = {r.id: r.n_links for r in found}
    assert all(got[k] <= near[k].sum() for k in got)
    assert sum(got.values()) >= 0.9 * near.sum()
    want = component_of(range(len(x)), [tuple(map(int, p)) for p in np.argwhere(near) if p[0] < p[1]])
    assert np.mean([want[r.id] == r.component_id for r in found]) >= 0.9


def test_odd_embeddings_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.0]), (10, [3.0, 0.0]), (11, [-1.0, 0.0])]
    for kind in ("double", "float"):
        found = cross_polytope.near_duplicates(frame(spark, rows, schema=f"vec_id long, embedding array<{kind}>")).collect()
        got = sorted(((r.id, r.n_links, r.component_id) for r in found), key=repr)
        want = [(1, 4, 1), (2, 4, 1), (2, 4, 1), (None, 4, 1), (10, 4, 1)] + [(k, 0, k) for k in (3, 4, 5, 6, 7, 8, 9, 11)]
        assert got == sorted(want, key=repr)
    assert cross_polytope.near_duplicates(frame(spark, [], schema="vec_id long, embedding array<float>")).count() == 0


TABLE = {"op3": "pages", "op8": "embeddings"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_returns_a_row_for_each_row(spark, name):
    source = TABLE.get(name.split("_")[0], "documents")
    assert QUERIES[name](spark, DATA).count() == spark.read.parquet(f"{DATA}/{source}.parquet").count()


def test_pipeline_keeps_clean_documents_and_one_of_each_copy(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    clean = [(k, "\n".join(body(f"doc{k}", 6))) for k in range(30, 60)]
    item = " ".join(f"item{k}" for k in range(50))
    rows = clean + [(70, clean[0][1]), (71, "start of it\n" + item + "\nend of it"), (72, "you are such a moron and scum"), (73, None)]
    rows += [(100 + k, "\n".join(body(f"doc{200 + k}", 6)) + " scum") for k in range(20)]
    labels = [(k, 0) for k, _ in clean] + [(100 + k, 1) for k in range(20)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "encoding"]
    found = pipeline.run(spark, str(tmp_path))
    assert found.columns == [*docs.columns, "ids", "n_ids"]
    kept = {r.doc_id: r.text for r in found.collect()}
    assert set(kept) == {k for k, _ in clean} | {73}
    assert all(kept[k] == t for k, t in clean)
    assert SENTENCE and EXTRA
    empty = docs.limit(0)
    for _, stage in pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
        assert empty.count() == 0
