import random
import string

from retailpulse.llm import toxicity


def letters(rng, n):
    return "".join(rng.choice(string.ascii_lowercase) for _ in range(n))


def score(machine, words):
    return machine.probability(machine.margins(words).max())


def test_insults_late_in_long_words_are_learned():
    rng = random.Random(1)
    common = [letters(rng, 6) for _ in range(200)]
    texts = [[*rng.sample(common, 12), letters(rng, 45) + ("scumbagmoron" if k % 2 else "")] for k in range(200)]
    machine = toxicity.fit_words([sorted(t) for t in texts], [k % 2 for k in range(200)], 0.5)
    new = [[*rng.sample(common, 12), letters(rng, 45)] for _ in range(50)]
    assert all(score(machine, [*t[:-1], t[-1] + "scumbagmoron"]) > 0.5 for t in new)
    assert all(score(machine, t) < 0.5 for t in new)


def test_words_seen_once_are_learned_however_many_there_are():
    rng = random.Random(2)
    syllables = ["an", "ber", "cor", "del", "est", "fin", "gol", "hat", "in", "jor"]
    texts = [["".join(rng.choice(syllables) for _ in range(6)) for _ in range(340)] for _ in range(200)]
    assert len(set().union(*texts)) > 60_000
    for k in range(0, 200, 2):
        texts[k].append("zzscumbag" + letters(rng, 3))
    machine = toxicity.fit_words([sorted(set(t)) for t in texts], [(k + 1) % 2 for k in range(200)], 0.5)
    assert all(score(machine, t) > 0.5 for t in texts[::2]) and all(score(machine, t) < 0.5 for t in texts[1::2])
