import random
import re

from odd import frame
from retailpulse.llm import line_chunks


def n_words(line):
    return len([w for w in re.split(r"[\x20\x09-\x0D]+", line) if w])


def brute_force(rows):
    """Text left of each document: what lies in a passage that an earlier place holds goes."""
    seen, left = set(), {}
    for doc_id, text in sorted(rows):
        lines, gone, own = text.split("\n"), set(), []
        wordy = [k for k, line in enumerate(lines) if n_words(line)]
        spans = list(zip(wordy, wordy[1:])) + [(k, k) for k in wordy if n_words(lines[k]) >= 50]
        for first, last in sorted(spans):
            low = max([k + 1 for k in wordy if k < first], default=0)
            high = min([k for k in wordy if k > last], default=len(lines))
            for s, e in {(first, last), (low, last), (first, high - 1), (low, high - 1)}:
                passage = ((first - s, e - last), tuple(lines[s:e + 1]))
                if passage in seen or passage in own:
                    gone.update(range(s, e + 1))
                own.append(passage)
        seen.update(own)
        left[doc_id] = "\n".join(line for k, line in enumerate(lines) if k not in gone)
    return left


def without_repeats(spark, rows):
    return {r.doc_id: r.text for r in line_chunks.without_repeats(frame(spark, rows)).collect()}


def test_common_lines_side_by_side_are_no_passage(spark):
    rows = [(1, "alpha one\nfirst own"), (2, "beta two\nsecond own"), (3, "alpha one\nbeta two"), (4, "own\n\nalpha one\n\nbeta two\n\nfirst own"),
            (5, "mine\nalpha one\nbeta two\n\nyours")]
    found = without_repeats(spark, rows)
    assert [found[k] for k in (1, 2, 3, 4)] == [t for k, t in rows if k < 5]
    # Its lines come first in other documents, but document 3 has them together.
    assert found[5] == "mine\n\nyours"


def test_passages_against_every_earlier_place(spark):
    rng = random.Random(4)
    lines = [f"short {k}" for k in range(12)] + ["", "", "  ", " ".join(f"w{k}" for k in range(50)), " ".join(f"v{k}" for k in range(49))]
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 12)))) for k in range(150)]
    rows += [(200 + k, "\n".join([f"own {k}"] + rows[k][1].split("\n")[1:4] + ["", f"end {k}"])) for k in range(60)]
    want = brute_force(rows)
    assert without_repeats(spark, rows) == want
    assert sum(want[k] != t for k, t in rows) > 60 and sum(want[k] == t for k, t in rows) > 20


def test_every_passage_of_three_short_lines_is_found(spark):
    passages = ["\n".join(" ".join(f"p{k}l{j}w{i}" for i in range(18)) for j in range(3)) for k in range(120)]
    rows = [(1 + k, f"before {k}\n{p}\nafter {k}") for k, p in enumerate(passages)]
    rows += [(1000 + k, f"other {k}\n{p}\nlast {k}") for k, p in enumerate(passages)]
    found = without_repeats(spark, rows)
    assert all(found[k] == t for k, t in rows[:120])
    assert all(found[1000 + k] == f"other {k}\nlast {k}" for k in range(120))


def test_words_lie_between_any_white_space(spark):
    tabs = "\t".join(f"t{k}" for k in range(60))
    rows = [(1, f"one\n{tabs}\ntwo"), (2, f"three\n{tabs}\nfour"), (3, "five\r\n\r\nshared line\r\nsix\r"), (4, "seven\r\n\r\nshared line\r\neight\r"),
            (5, "nine  \n \t\nshared   line  with blanks" + " " * 60 + "\nten"), (6, "eleven\n \t\nshared   line  with blanks" + " " * 60 + "\ntwelve")]
    found = without_repeats(spark, rows)
    assert found[2] == "three\nfour" and all(found[k] == t for k, t in rows if k != 2)
    assert found == brute_force(rows)
