import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemart.llm import quality_rules as q

SCHEMA = "doc_id long, text string, lang string, source string, n_words string"
TEXTS = [
    None, "", " \n\t", "one", "a b c d e", "a b c d e a b c d e", "x " * 40, "#$ %% <a>|\n#$ %% <a>|\n\n \n \nlast",
    "l1 x\nl1 x\n l1 x\nl1 x", "é\u00a0b\x0bc\x1cd", "😀 " * 12, "a b c a b c a b c a b", "\n".join(["same line here now ok"] * 9),
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    held = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(held),
    )


def random_texts():
    r = random.Random(8)
    out = []
    for _ in range(150):
        words = [r.choice(["aa", "b#", "Cé", "<d>", "e"]) for _ in range(r.randrange(80))]
        out.append("".join(w + r.choice([" ", " ", "\n", "  "]) for w in words))
    return out


def test_counts(spark):
    texts = TEXTS + random_texts()
    rows = spark.createDataFrame([(i, t, "en", "s", "x") for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: tuple(r[c] for c in q.STATS) for r in q.with_statistics(rows).collect()}
    for i, text in enumerate(texts):
        assert got[i] == plain(text), repr(text)


def corpus():
    r = random.Random(6)
    word = lambda: "".join(r.choice("aeioulnrst") for _ in range(r.randrange(2, 9)))
    rows = []
    for i in range(900):
        words = [word() for _ in range(r.randrange(12, 200))]
        if i % 30 == 0:
            words = [w + "%%%" for w in words]
        elif i % 30 == 1:
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words), r.choice(["en", "de", None]), r.choice(["a", "a", "a", "b", None]), "x"))
    return rows


def test_outliers_and_clean_documents(spark):
    rows = corpus() + [(1000, "too short", "en", "a", "x"), (1001, None, "zz", "new", None), (1002, "w " * 30, "en", "a", "x")]
    got = {r["doc_id"]: r for r in q.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    for i in range(900):
        assert not got[i]["base_failed"]
        assert got[i]["kept"] == (i % 30 > 1), i
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i in (1000, 1001, 1002))
    kept = q.keep_good(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_words"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i]["kept"]}


def test_same_as_a_plain_estimate(spark):
    """The estimate of one group against the same steps in numpy."""
    r = np.random.default_rng(2)
    x = r.standard_normal((3000, q.DIMS)) @ (np.eye(q.DIMS) + 0.3) + np.arange(q.DIMS)
    x[:300] += 9
    rows = spark.createDataFrame([(*map(float, v), "g") for v in x], [*(f"x{i}" for i in range(q.DIMS)), "g"])
    got = q.estimate(rows).first()
    grow = q.consistency(0.75)
    low, mid, high = np.quantile(x, [0.25, 0.5, 0.75], axis=0, method="inverted_cdf")
    centre, spread = mid, np.diag(np.maximum((high - low) / 1.349, q.FLOORS) ** 2)
    for _ in range(4):
        d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(spread), x - centre)
        core = x[d <= np.quantile(d, 0.75, method="inverted_cdf")]
        centre, spread = core.mean(0), np.cov(core.T, bias=True) * grow + np.diag(np.square(q.FLOORS))
    factor = np.linalg.cholesky(spread)
    for i in range(q.DIMS):
        assert got[f"m{i}"] == pytest.approx(centre[i], abs=0.02)
        for j in range(i + 1):
            assert got[f"l{i}{j}"] == pytest.approx(factor[i, j], abs=0.03)


def test_empty_table_and_labels(spark):
    assert q.judge(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = q.judge(docs).join(labels, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept"),
        F.avg((F.col("kept") | F.col("base_failed")).cast("int")).alias("method"),
    )
    rates = {r["quality"]: r for r in found.collect()}
    assert rates[1]["method"] > 0.995 and rates[0]["kept"] < 0.25
