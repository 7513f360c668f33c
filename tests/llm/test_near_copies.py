import importlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd import frame, odd_texts
from retailpulse.llm import near_copies
from retailpulse.llm.simhash_pivots import wide_links
from test_duplicates import component_of


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    """Component of each row by the exact similarity of all pairs, and how similar the linked ones are."""
    sets = {k: plain_shingles(t) for k, t in rows}
    shared = {(a, b): len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b])) for a in sets for b in sets if a < b}
    links = [p for p, x in shared.items() if x >= 0.8]
    return component_of(sets, links), [shared[p] for p in links]


def altered_texts():
    """Texts of 60 to 400 words, each with four copies in which one to ten words are others."""
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(30):
        words = [f"w{k}" for k in rng.integers(0, 5000, int(rng.integers(60, 400)))]
        rows.append(" ".join(words))
        for changes in rng.integers(1, 11, 4):
            copy = words[:]
            for at in rng.integers(0, len(words), changes):
                copy[at] = f"new{rng.integers(0, 5000)}"
            rows.append(" ".join(copy))
    return list(enumerate(rows))


@pytest.mark.parametrize("part_rows", [2, 512])
def test_copies_of_similarity_080_to_095_against_all_pairs(spark, part_rows):
    rows = altered_texts()
    want, similarities = brute_force(rows)
    assert sum(0.8 <= x < 0.85 for x in similarities) > 5 and sum(0.85 <= x < 0.95 for x in similarities) > 10
    found = near_copies.near_copies(frame(spark, rows), part_rows=part_rows).collect()
    least = {}
    for r in found:
        least[r.root] = min(r.doc_id, least.get(r.root, r.doc_id))
    assert {r.doc_id: least[r.root] for r in found} == want


def test_stage_keeps_one_of_each_near_copy(spark):
    rows = altered_texts()
    want, _ = brute_force(rows)
    pipeline = importlib.import_module("corpus_pipeline")
    kept = pipeline.without_near_copies(spark, frame(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("part_rows", [8, 4096])
def test_simhash_pivots_propose_the_near_copies(spark, part_rows):
    """The pivots alone link similar texts and no others; rows without words have no print to search."""
    rows = altered_texts()
    sets = {k: plain_shingles(t) for k, t in rows}
    nodes = near_copies.prints(frame(spark, rows)).select(F.col("doc_id").alias("node"), "print")
    linked = [tuple(r) for r in wide_links(nodes, part_rows=part_rows).collect()]
    shared = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in linked}
    assert min(shared.values()) > 0.2
    group = component_of(sets, linked)
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert sum(group[a] == group[b] for a, b in pairs) >= 0.99 * len(pairs) and len(pairs) > 50


@pytest.mark.parametrize("kept", ["keys", "print"])
def test_both_ways_to_candidates_are_taken(spark, kept):
    """A pair that only one of the two finds is a candidate."""
    words = [f"w{k}" for k in range(300)]
    rows = near_copies.prints(frame(spark, [(1, " ".join(words)), (2, " ".join([*words, "more"]))]))
    other = F.transform("keys", lambda k: k + F.col("doc_id")) if kept == "print" else F.col("keys")
    blank = F.when(F.col("doc_id") == 1, F.unhex(F.lit("00" * 128))).otherwise(F.unhex(F.lit("FF" * 128)))
    rows = rows.withColumn("keys", other).withColumn("print", blank if kept == "keys" else F.col("print"))
    found = near_copies.candidates(rows).collect()
    assert len(found) == 2 and len({r.root for r in found}) == 1


def test_near_copies_of_odd_rows(spark):
    rows = odd_texts()
    found = near_copies.near_copies(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    kept = near_copies.one_of_each(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=repr) == sorted([1, 3, 6, 7, 8, 9, 12], key=repr)
    assert near_copies.near_copies(frame(spark, [])).count() == 0 and near_copies.one_of_each(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        near_copies.near_copies(frame(spark, []), similarity=0.5)
