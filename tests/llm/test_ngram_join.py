import random
from collections import Counter

import pytest

from pulsemart.llm import ngram_join
from pulsemart.llm.common import components

SCHEMA = "doc_id long, text string, n_copies long, s string, class_id string"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x", None) for i, t in texts], SCHEMA)


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(texts):
    sets = [shingles(t) for _, t in texts]
    n = len(sets)
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i in range(n):
        least.setdefault(find(i), []).append(texts[i][0])
    return sorted((texts[i][0], min(least[find(i)]), links[i]) for i in range(n))


def corpus():
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(60):
        base = [word() for _ in range(r.randrange(3, 90))]
        for _ in range(r.choice([1, 1, 2, 5])):
            copy = [word() if r.random() < r.choice([0, 0, 0.01, 0.03]) else w for w in base]
            texts.append(" ".join(copy))
    big = [word() for _ in range(120)]
    texts += [" ".join(word() if r.random() < 0.01 else w for w in big) for _ in range(150)]
    texts += [" ".join(big)] * 40 + ["", " \n", None, "one two", "One  TWO", "x " * 4000, "x " * 3000]
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block, bucket", [(1024, 128), (16, 8)])
def test_same_as_brute_force(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)
    texts = corpus()
    got = ngram_join.join(rows(spark, texts)).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == brute_force(texts)


def test_one_of_each_class_stays(spark):
    texts = corpus()
    kept = ngram_join.keep_one(rows(spark, texts + texts[:5]))
    assert kept.columns == ["doc_id", "text", "n_copies", "s", "class_id"]
    got = Counter(r["doc_id"] for r in kept.collect())
    assert got == Counter({c for _, c, _ in brute_force(texts)})


def test_empty_table(spark):
    assert ngram_join.join(rows(spark, [])).collect() == []
    assert ngram_join.keep_one(rows(spark, [])).collect() == []


def test_rows_without_a_number(spark):
    got = ngram_join.join(rows(spark, [(None, "a b c d e f"), (4, "a b c d e f"), (None, "")])).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 4, 1, 2), (4, 4, 1, 2), (None, None, 0, 1)], key=str)


def test_components_of_chains_and_stars(spark):
    r = random.Random(2)
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(200)] + [(5000, 5000)]
    r.shuffle(chain)
    edges = spark.createDataFrame(chain + star, "a long, b long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(201)}


def test_runs_grow_with_the_recall():
    assert ngram_join.run_count(0.9) < ngram_join.run_count(0.999) < 15


def test_many_rows_with_one_doc_id_or_none(spark):
    """Rows with a passage in common; joined by doc_id alone, m of them would meet m times each."""
    r = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    base = [r.choice(words) for _ in range(60)]

    def near():
        other = list(base)
        other[r.randrange(60)] = r.choice(words)
        return " ".join(other)

    for doc_id in (None, 5):
        rows = [(doc_id, near()) for _ in range(400)]
        found = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert len(found) == 400
        assert min(f["n_links"] for f in found) > 0


def test_texts_stay_where_few_ids_go(spark, conf):
    """The ids of what goes are a small table, which comes to the documents."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = ngram_join.keep_one(rows(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
