import hashlib
import random

import pyarrow as pa
import pytest

from pulsemart.llm import repeats

SCHEMA = "doc_id long, text string, n_bytes long, spans string"


def corpus(seed):
    r = random.Random(seed)
    alphabet = "abcdé  \n"
    make = lambda n: "".join(r.choice(alphabet) for _ in range(n))
    shared = [make(n) for n in (350, 398, 400, 401, 405, 520, 900, 2500)]
    texts = [make(r.randrange(1500)) for _ in range(20)]
    for _ in range(40):
        parts = []
        for _ in range(r.randrange(1, 4)):
            parts.append(make(r.choice([0, 1, 30, 400])))
            part = r.choice(shared)
            begin = r.randrange(max(1, len(part) - 300))
            parts.append(part[begin:] if r.random() < 0.5 else part[: len(part) - begin])
        texts.append("".join(parts))
    texts += ["", None, "a" * 399, "b" * 400, "c" * 401, "xy" * 700, texts[0], texts[3], texts[3]]
    texts += [make(700)] * 3 + [make(300)] * 2
    r.shuffle(texts)
    return list(enumerate(texts))


def brute_force(texts):
    data = [(t or "").encode() for _, t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - 399):
            seen[d[i : i + 400]] = seen.get(d[i : i + 400], 0) + 1
    out = []
    for (doc, _), d in zip(texts, data, strict=True):
        gone = bytearray(len(d) + 1)
        for i in range(len(d) - 399):
            if seen[d[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        n_spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(d)))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((doc, len(d), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(repeats, "BLOCK_NAMES", 40)
    texts = corpus(seed)
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], SCHEMA).repartition(3)
    assert sorted(map(tuple, repeats.remove(rows).collect())) == brute_force(texts)


def test_odd_tables(spark):
    assert repeats.remove(spark.createDataFrame([], SCHEMA)).collect() == []
    same = [(5, "q" * 500, 1, "x"), (5, "q" * 500, 1, "x"), (5, "other", 1, None), (None, "q" * 450, 1, "x")]
    got = sorted(map(tuple, repeats.remove(spark.createDataFrame(same, SCHEMA)).collect()), key=str)
    assert [r[:4] for r in got] == [(5, 5, 0, 0), (5, 500, 500, 1), (5, 500, 500, 1), (None, 450, 450, 1)]


def test_every_string_has_a_sample_at_the_same_place():
    r = random.Random(9)
    for make in (lambda: r.choice(b"abcdef"), lambda: r.choice(b"ab"), lambda: 97):
        common = bytes(make() for _ in range(1000))
        one = repeats.sampled(bytes(make() for _ in range(333)) + common + b"z" * 200)
        two = repeats.sampled(b"y" * 71 + common + bytes(make() for _ in range(50)))
        one, two = set((one - 333).tolist()), set((two - 71).tolist())
        for start in range(0, 600):
            near = set(range(start, start + repeats.COVER))
            assert one & two & near


def test_few_strings_are_named_around_a_border():
    """One string for each place of a sample took more disk than all else; shuffled, twice the input."""
    r = random.Random(4)
    data = bytes(r.choice(b"abcdef ") for _ in range(20_000))
    at = repeats.sampled(data)
    every = b"\1" * len(at)
    columns = {
        "t": pa.array([1], pa.int64()),
        "at": pa.array([at.astype("<u4").tobytes()], pa.binary()),
        "flags": pa.array([every], pa.binary()),
        "data": pa.array([data], pa.binary()),
        "asked": pa.array([every], pa.binary()),
    }
    (found,) = repeats.answers(iter([pa.RecordBatch.from_pydict(columns)]))
    assert len(found["hashes"][0].as_py()) // 8 < 14 * len(at) < len(data) / 2


def plan_of(df):
    """Each line of the plan with the lines above it, from the nearest one up to the root."""
    above = []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-*|()0123456789"))
        above = [x for x in above if x[0] < depth]
        yield line, [x[1] for x in reversed(above)]
        above.append((depth, line))


def steps_of(monkeypatch, module):
    """The plans of all steps that a module saves, as they come."""
    found = []
    for name in ("saved", "saved_by"):
        if save := getattr(module, name, None):
            monkeypatch.setattr(module, name, lambda df, *a, save=save: found.append([*plan_of(df)]) or save(df, *a))
    return found


def test_one_worker_a_task(spark, monkeypatch, conf):
    """Two steps of Python in a task take two workers each, which stay with all they remember."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = steps_of(monkeypatch, repeats)
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in corpus(3)], SCHEMA)
    repeats.remove(rows).collect()
    assert any("MapInArrow" in line for step in found for line, _ in step)
    for step in found:
        for line, above in step:
            if "MapInArrow" in line:
                same = next((x for x in above if "Exchange" in x or "MapInArrow" in x), "")
                assert "MapInArrow" not in same


def test_texts_stay_where_they_are(spark, monkeypatch, conf):
    """What is told of texts comes to them; they moved three times more, and with them the disk."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = steps_of(monkeypatch, repeats)
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in corpus(3)], SCHEMA)
    repeats.remove(rows).collect()
    scans = [x for step in found for x in step if "Scan" in x[0] and "data#" in x[0] and "flags#" in x[0]]
    assert len(scans) >= 3
    assert not [line for line, above in scans if any("Exchange" in x for x in above)]


def test_texts_with_one_id(spark):
    """Texts are told apart by doc_id and text, whichever of the two they share."""
    r = random.Random(8)
    make = lambda n: "".join(r.choice("abcd ") for _ in range(n))
    long = make(900)
    texts = [(1, long), (1, make(50) + long[200:]), (2, long[:700]), (None, long[100:]), (None, make(600))]
    texts += [(None, long[100:]), (1, long), (3, None)]
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], SCHEMA).repartition(3)
    plain = lambda found: sorted(map(tuple, found), key=str)
    numbered = brute_force([*enumerate(t for _, t in texts)])
    assert plain(repeats.remove(rows).collect()) == plain((texts[n][0], *rest) for n, *rest in numbered)


def test_texts_stay_where_few_are_cut(spark, conf):
    """Where the spans are a small table, they go to the texts; any threshold of Spark's own aside."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in corpus(4)], SCHEMA)
    plan = repeats.cut(rows)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_candidates_go_when_spans_stand(spark):
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in corpus(5)], SCHEMA)
    found = repeats.remove(rows)
    for database in spark.catalog.listDatabases():
        tables = [t.name for t in spark.catalog.listTables(database.name)]
        assert not [t for t in tables if t.startswith("candidates")]
    assert found.count() == len(corpus(5))
