import random

import numpy as np

from pulsemart.llm import decontaminate as d

DOCS = "doc_id long, text string, leaks string, item_id long"


def words(r, n):
    return ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 7))) for _ in range(n)]


def test_leaks_are_found_and_clean_texts_left(spark):
    r = random.Random(5)
    common = words(r, 30)
    text = lambda n: [r.choice(common) if r.random() < 0.5 else words(r, 1)[0] for _ in range(n)]
    items = [(i, text(r.choice([8, 20, 40, 60, 150])), None) for i in range(40)]
    docs, want = [], set()
    for i in range(300):
        body = text(r.randrange(0, 400))
        if i % 3 == 0:
            k, own, _ = r.choice(items)
            own = [w if r.random() > 0.08 else words(r, 1)[0] for w in own]
            at = r.randrange(len(body) + 1)
            body[at:at] = own
            want.add((i, k))
        docs.append((i, " ".join(body).upper() if i % 5 == 0 else "\n".join(body), "x", 1))
    docs += [(900, None, None, None), (901, "", None, None), (902, "short", None, None), (None, " ".join(items[1][1]), None, None)]
    bench = [(i, " ".join(t), a) for i, t, a in items] + [(100, None, None), (101, "too few words", None)]
    b = spark.createDataFrame(bench, "item_id long, text string, answer string")
    rows = spark.createDataFrame(docs, DOCS)
    got = {(x["doc_id"], x["item_id"]) for x in d.leaks(rows, b).collect()}
    assert got == want | {(None, 1)}
    clean = d.keep_clean(rows, b)
    assert clean.columns == ["doc_id", "text", "leaks", "item_id"]
    assert {x["doc_id"] for x in clean.collect()} == {x[0] for x in docs} - {i for i, _ in want} - {None}


def test_answers_lower_what_must_agree(spark):
    r = random.Random(1)
    item = words(r, 30)
    answer = ["the", "answer", "word"]
    half = [w if k % 9 < 4 else words(r, 1)[0] for k, w in enumerate(item)]
    rows = [(1, " ".join(half + answer), "", 0), (2, " ".join(half), "", 0)]
    docs = spark.createDataFrame(rows + [(10 + i, " ".join(words(r, 50)), "", 0) for i in range(50)], DOCS)
    b = spark.createDataFrame([(7, " ".join(item), "The answer word")], "item_id long, text string, answer string")
    assert [(x["doc_id"], x["answer"]) for x in d.leaks(docs, b).collect()] == [(1, True)]


def test_empty_tables(spark):
    docs, b = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert d.leaks(docs, b).collect() == []
    some = spark.createDataFrame([(1, "a b c d e f", "", 0)], DOCS)
    assert d.leaks(some, b).collect() == [] and d.keep_clean(some, b).count() == 1


def test_directions_are_those_of_the_matrix(spark):
    r = np.random.default_rng(4)
    dense = np.zeros((30, 500))
    used = r.choice(500, 50, replace=False)
    dense[:, used] = r.standard_normal((30, 4)) @ np.diag([9, 5, 3, 2]) @ r.standard_normal((4, 50))
    rows = [(np.flatnonzero(x).tolist(), x[np.flatnonzero(x)].tolist()) for x in dense]
    got = d.randomised_svd(spark.createDataFrame(rows, "features array<int>, weights array<float>"), 500, rank=8)
    _, _, true = np.linalg.svd(dense[:, used], full_matrices=False)
    assert np.linalg.norm(true[:4] @ got[used], axis=1).min() > 0.999


def test_common_length():
    r = random.Random(3)
    for _ in range(200):
        a = [r.choice("abcd") for _ in range(r.randrange(12))]
        b = [r.choice("abcd") for _ in range(r.randrange(12))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert d.common_length(a, b) == t[-1][-1]


def prose(r, common, rare, n):
    """Half of the words from a few frequent ones, the others from many rare ones."""
    return [r.choice(common) if r.random() < 0.5 else r.choice(rare) for _ in range(n)]


def planted(seed, sizes, share):
    """Documents each with an item whose rarest words are replaced by others, and the items."""
    r = random.Random(seed)
    common, rare = words(r, 40), list(dict.fromkeys(words(r, 4000)))
    items = [prose(r, common, rare, r.choice(sizes)) for _ in range(150)]
    docs = []
    for k, item in enumerate(items):
        order = sorted(range(len(item)), key=lambda i: (item[i] in common, i))
        gone = set(order[: int(len(item) * share)])
        body = prose(r, common, rare, 150)
        at = r.randrange(150)
        body[at:at] = [r.choice(rare) if i in gone else w for i, w in enumerate(item)]
        docs.append((k, " ".join(body), "x", 1))
    return docs, [(k, " ".join(t)) for k, t in enumerate(items)]


def test_no_pair_of_the_rule_is_lost(spark):
    """Paraphrases without the rare words, and exact items of 5 to 10 words."""
    for seed, sizes, share in [(1, range(15, 60), 0.38), (2, range(15, 60), 0.25), (3, range(5, 11), 0)]:
        docs, items = planted(seed, sizes, share)
        rows = spark.createDataFrame(docs, DOCS)
        b = spark.createDataFrame(items, "item_id long, text string")
        got = {(x["doc_id"], x["item_id"]) for x in d.leaks(rows, b).collect()}
        assert {(k, k) for k in range(len(items))} <= got


def test_long_items_spread_out(spark):
    """An item of several passages, a fifth of its length inserted in one place of it."""
    r = random.Random(8)
    item = words(r, 200)
    body = words(r, 100) + item[:70] + words(r, 40) + item[70:] + words(r, 100)
    docs = spark.createDataFrame([(1, " ".join(body), "", 0)], DOCS)
    b = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    (x,) = d.leaks(docs, b).collect()
    assert x["item_id"] == 7 and x["common"] == 1 and 80 < x["place"] <= 100 and x["cosine"] > 0.8


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = planted(4, range(10, 40), 0.2)
    docs += [(500 + i, " ".join(words(random.Random(i), 60)), "x", 1) for i in range(20)]
    rows = spark.createDataFrame(docs + docs[:3], DOCS)
    b = spark.createDataFrame(items[:100], "item_id long, text string")
    pairs = lambda: sorted((x["doc_id"], x["item_id"]) for x in d.leaks(rows, b).collect())
    clean = lambda: sorted(map(tuple, d.keep_clean(rows, b).collect()))
    found, left = pairs(), clean()
    monkeypatch.setattr(d, "ITEM_BLOCK", 30)
    assert (pairs(), clean()) == (found, left)
    assert len(left) == 70


def test_directions_take_one_worker_a_task(spark, monkeypatch):
    """The items' weights are read from files; made on the way, each task took a second worker."""
    plans, svd = [], d.randomised_svd

    def seen(vectors, *rest):
        plans.append(vectors._jdf.queryExecution().executedPlan().toString())
        return svd(vectors, *rest)

    monkeypatch.setattr(d, "randomised_svd", seen)
    r = random.Random(6)
    bench = [(i, " ".join(words(r, 20)), None) for i in range(30)]
    docs = [(i, " ".join(words(r, 30)), "x", 1) for i in range(20)]
    b = spark.createDataFrame(bench, "item_id long, text string, answer string")
    assert d.leaks(spark.createDataFrame(docs, DOCS), b).count() == 0
    assert len(plans) == 1 and "MapInArrow" not in plans[0]
