import math
import random
from collections import Counter

import pytest

from pulsemart.llm import lm_scoring

SCHEMA = "doc_id long, text string, n_words long, block string"


def corpus():
    r = random.Random(4)
    texts = [" ".join(r.choice(["a", "B", "c", "dd", "e"]) for _ in range(r.randrange(30))) for _ in range(60)]
    texts += ["", None, " \n ", "new words only here", "a", "a a a a a", texts[0], texts[0]]
    return list(enumerate(texts)) + [(None, "a b c")]


def grams(words, n):
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]


def brute_force(texts, order, leave_out):
    split = [(t or "").lower().split() for _, t in texts]
    all_counts = Counter(g for w in split for n in range(1, order + 1) for g in grams(w, n))
    total = sum(map(len, split))
    out = []
    for (doc, _), words in zip(texts, split, strict=True):
        own = Counter(g for n in range(1, order + 1) for g in grams(words, n)) if leave_out else Counter()
        count = lambda g: all_counts[g] - own[g]  # noqa: B023, E731
        n = total - leave_out * len(words)
        sums = short = 0
        for i in range(len(words)):
            longest, factor, value = min(i + 1, order), 1.0, None
            for size in range(longest, 1, -1):
                g = tuple(words[i - size + 1 : i + 1])
                if count(g) > 0:
                    value = factor * count(g) / count(g[:-1])
                    break
                factor *= 0.4
            else:
                size, c = 1, count((words[i],))
                value = factor * (c / n if c > 0 else 0.4 / (n + 1))
            short += size < longest or count((words[i],)) <= 0
            sums += math.log(value)
        out.append((doc, len(words), short, sums))
    return out


@pytest.mark.parametrize("order, leave_out", [(2, True), (3, True), (2, False), (1, True), (5, True), (5, False), (6, True)])
def test_same_as_brute_force(spark, monkeypatch, order, leave_out):
    monkeypatch.setattr(lm_scoring, "BLOCK_WORDS", 90)
    texts = corpus()
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], SCHEMA).repartition(3)
    got = sorted(map(tuple, lm_scoring.score(rows, order, leave_out).collect()), key=lambda r: (r[0] or -1))
    want = sorted(brute_force(texts, order, leave_out), key=lambda r: (r[0] or -1))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[3] == pytest.approx(b[3])
        assert a[4] == (pytest.approx(b[3] / b[1]) if b[1] else None)


def test_steps_hold_every_length_once():
    for order in range(1, 10):
        assert [n for a, b in lm_scoring.steps(order) for n in range(a, b + 1)] == list(range(1, order + 1))


def test_empty_table(spark):
    assert lm_scoring.score(spark.createDataFrame([], SCHEMA)).collect() == []


def test_shuffled_phrases_score_below_fluent_text(spark):
    """Every word pair is common, the longer runs are not: the registered order tells them apart."""
    r = random.Random(6)
    fluent = ["a b c d e f", "x b c y e z", "a b q d e z", "x b q y e f"]
    texts = [r.choice(fluent) for _ in range(200)] + ["a b c y e f"]
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], SCHEMA)
    short = {x["doc_id"]: x["n_backoff"] for x in lm_scoring.score(rows).collect()}
    assert short[200] > 0 and all(short[i] == 0 for i in range(200))
