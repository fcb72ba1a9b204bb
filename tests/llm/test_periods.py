import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from pulsemart.llm import periods, queries

SCHEMA = "doc_id long, text string, runs string, id int, collapsed string"


def plain_runs(words):
    """For every period every maximal stretch of words that equal their copies, if it is the least."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(24, 3 * q):
                smaller = any(
                    all(words[t] == words[t + p] for t in range(s, s + length - p))
                    for p in range(1, q)
                )
                if not smaller:
                    out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs(words)
    keep = [not any(s + q <= i < s + length for s, length, q in runs) for i in range(n)]
    kept = " ".join(w for w, k in zip(words, keep, strict=True) if k)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    shown = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (
        doc_id, len(runs), *shown,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def random_words(r):
    """Few letters, with powers of short words in them and powers of powers."""
    out = []
    for _ in range(r.randrange(1, 6)):
        root = [r.choice("ab" if r.random() < 0.7 else "abcde") for _ in range(r.randrange(1, 12))]
        if r.random() < 0.3:
            root = root * r.randrange(1, 4) + [r.choice("abc")]
        out += root * r.randrange(1, 9)
        out += out[-len(root) :][: r.randrange(len(root))]
        out += [r.choice("abcxyz") for _ in range(r.randrange(4))]
    return out


def test_runs_are_those_of_all_periods_tried():
    r = random.Random(3)
    for _ in range(1500):
        words = random_words(r)
        found = [(x.start, x.length, x.period) for x in periods.find_runs(periods.numbered(words))]
        assert found == plain_runs(words), words


def test_a_fibonacci_word_and_powers_of_long_roots():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    for words in (list(b), list("ab" * 200), list("a" * 24), list("a" * 23), list(b[:60] * 5 + "x")):
        found = [(x.start, x.length, x.period) for x in periods.find_runs(periods.numbered(words))]
        assert found == plain_runs(words)


def test_a_very_long_text():
    r = np.random.default_rng(1)
    root = r.integers(0, 1000, 70_001)
    ids = np.concatenate([r.integers(1000, 2000, 50_000), root, root, root, root[:5], [5000]])
    found = periods.find_runs(ids)
    assert periods.Run(50_000, 70_001, 3 * 70_001 + 5) in found
    ones = np.zeros(1_000_000, np.int64)
    assert periods.find_runs(ones) == [periods.Run(0, 1, 1_000_000)]


ODD = [
    (1, None, "r", 1, "c"),
    (2, "", None, None, None),
    (3, " \n\t ", None, None, None),
    (4, "a " * 24, None, None, None),
    (5, "a " * 23, None, None, None),
    (None, "a b " * 30, None, None, None),
    (None, None, None, None, None),
    (6, "é é\x1c é é\x1c\x0b" * 15, None, None, None),
    (6, "same same", None, None, None),
    (6, "same same", None, None, None),
]


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, v) for v in r))


def test_rows_and_planted_runs(spark):
    r = random.Random(8)
    rows = ODD + [(i, " ".join(random_words(r)), None, None, None) for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = periods.digests(periods.collapse(df, prepare=periods.with_planted_run))
    assert order(found.collect()) == order(plain(i, t) for i, t, *_ in rows)
    empty = df.limit(0)
    assert periods.digests(periods.collapse(empty)).collect() == []


def test_the_text_left(spark):
    df = spark.createDataFrame([(1, "x " + "a b c " * 10 + "d", "", 0, "")], SCHEMA)
    row = periods.collapse(df).first()
    assert row["collapsed"] == "x a b c d"
    assert [tuple(r) for r in row["runs"]] == [(1, 30, 3)]


def test_query_against_all_periods_tried(spark):
    """Texts of the smallest table, up to 2500 words, as the plain way takes the square of a text."""
    sf_dir = "/root/testdata/sf0.001"
    texts = {
        r["doc_id"]: r["text"]
        for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    }
    found = queries.op13_periodic_runs(spark, sf_dir).collect()
    assert len(found) == len(texts)
    short = [r for r in found if len((texts[r["doc_id"]] or "").split()) <= 2500]
    assert len(short) > 0.9 * len(texts)
    assert order(short) == order(plain(r["doc_id"], texts[r["doc_id"]]) for r in short)


@pytest.mark.parametrize("n", [0, 1, 2, 23])
def test_too_few_words(n):
    assert periods.find_runs(np.zeros(n, np.int64)) == []
