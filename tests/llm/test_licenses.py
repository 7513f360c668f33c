"""The licence index (op11) against a scan of every place."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from odd import frame, odd_texts
from retailpulse.llm import license_index, queries
from retailpulse.llm.license_index import NOTICES, TEMPLATES, Index, words_of

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def plain_words(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def base_places(words):
    found = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return sorted(found)


def every_place(index, words):
    """Matches by trying every start of every template, without anchors."""
    found = []
    for k, t in enumerate(index.templates):
        own = words_of(t.text.encode())
        for at in range(-len(own), len(words)):
            weight = 0
            for j, w in enumerate(own):
                if w in words[max(0, at + j - t.drift):max(0, at + j + t.drift + 1)]:
                    weight += int(index.weight[index.number[w]])
            if weight * 100 < t.percent * index.total[k]:
                continue
            held = []
            for phrase in t.phrases:
                p = words_of(phrase.encode())
                held.append(any(words[s:s + len(p)] == p for s in range(max(0, at - t.drift), at + len(own) + t.drift - len(p) + 1)))
            if all(held):
                found.append((k, at, weight))
    return found


def noisy(rng, text):
    words = text.split()
    for _ in range(rng.randrange(0, 4)):
        i = rng.randrange(len(words) + 1)
        words[i:i + rng.randrange(2)] = rng.choice([["extra"], [], ["License"], ["software", "the"]])
    return " ".join(words)


def test_words_are_those_of_the_pattern():
    for _, text in odd_texts() + [(0, "ÀB-c_9\u0080é\u007f{|}İ ſ[z]@`a"), (1, "\n".join(map(chr, range(256))))]:
        assert [w.decode() for w in words_of((text or "").encode())] == plain_words(text)


def test_anchors_find_what_a_scan_of_every_place_finds():
    rng = random.Random(5)
    counts = {w: rng.choice([0, 1, 5, 90]) for w in license_index.vocabulary(TEMPLATES)}
    index = Index(TEMPLATES, 100, counts)
    texts = [noisy(rng, " ".join(rng.choice(TEMPLATES).text for _ in range(2)) + " some other words") for _ in range(60)]
    hits = 0
    for text in texts:
        words = words_of(text.encode())
        got = set(index.places(words))
        want = set(every_place(index, words))
        assert got <= want
        # Where no anchor stands exactly, too little stands exactly for a match without drift.
        for k, at, weight in want - got:
            own = words_of(index.templates[k].text.encode())
            in_place = [w for j, w in enumerate(own) if at + j >= 0 and words[at + j:at + j + 1] == [w]]
            assert sum(int(index.weight[index.number[w]]) for w in in_place) * 100 < index.templates[k].percent * index.total[k]
        hits += len(got)
    assert hits > 100


@pytest.mark.parametrize("template", NOTICES, ids=lambda t: f"{t.label}-{len(t.text)}")
def test_every_notice_is_found_among_other_words(template):
    index = Index(TEMPLATES, 1000, {})
    words = words_of(f"first some words. {template.text}. and more words follow".encode())
    spans = [s for s in index.spans(words) if s["label"] == template.label]
    assert any(s["share"] == 1.0 and s["start"] == 3 for s in spans)
    assert index.spans(words_of(b"a license is a software public version under the terms of it")) == []


def test_whole_tables_with_odd_rows(spark):
    rows = odd_texts() + [
        (20, "Released under the MIT License. Again UNDER the-mit_license! cc-by-nc"), (21, "Apache License, Version 2.0"), (22, "cc by nc " * 3000),
        (23, "the license " * 20_000), (24, "This work is licensed under the GNU General Public License, version 3."), (25, "by nc cc"),
    ]
    found = license_index.scan(frame(spark, rows).withColumn("licenses", F.lit(1)))
    got = found.collect()
    assert len(got) == len(rows) and "own fp" in got[0].asDict().values()
    plain = []
    for i, text in rows:
        words = plain_words(text)
        plain.append((i, len(words), base_places(words)))
    mine = [(r.doc_id, r.n_words, sorted((s.start, s.label) for s in r.licenses if s.base)) for r in got]
    assert sorted(mine, key=repr) == sorted(plain, key=repr)
    labels = {r.doc_id: {s.label for s in r.licenses} for r in got}
    assert labels[24] == {"gpl-3"} and labels[23] == set() and labels[25] == set() and labels[20] == {"mit", "cc-by-nc"}
    assert license_index.scan(frame(spark, [])).count() == 0


def test_query_equals_its_sql_on_odd_rows(spark, tmp_path):
    rng = random.Random(8)
    rows = odd_texts()[:9] + [(100 + k, noisy(rng, rng.choice(TEMPLATES).text) + " and " + rng.choice(TEMPLATES).text) for k in range(60)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op11_license_index(spark, str(tmp_path)).collect()]
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = duck.execute(queries.SQL["op11_license_index"]).fetchall()
    assert sorted(got, key=repr) == sorted(want, key=repr)
