"""Keys found from values, and pages of a browse table."""

import random

import pytest

from pulsemart.operators import connections, metrics


def plain(tables, least):
    columns = {(t, c): [r[i] for r in rows] for t, (names, rows) in tables.items() for i, c in enumerate(names)}
    out = []
    for a, child in columns.items():
        for b, parent in columns.items():
            mine, theirs = [v for v in child if v is not None], [v for v in parent if v is not None]
            if a == b or not mine or len(set(theirs)) < len(theirs) or type(mine[0]) is not type((theirs or [None])[0]):
                continue
            shared = set(mine) & set(theirs)
            if shared and len(shared) >= least * len(set(mine)):
                out.append(
                    (*a, *b, len(set(mine)), len(theirs), len(shared), sum(v not in shared for v in mine))
                )
    return sorted(out)


@pytest.mark.parametrize("least", [1.0, 0.5])
def test_same_as_comparing_every_pair(spark, least):
    r = random.Random(4)
    made = {
        "parents": (["id", "name", "other"], [(i, f"n{i}", r.randrange(5)) for i in range(40)]),
        "children": (
            ["k", "parent", "name", "note"],
            [(i, r.randrange(45) if i % 7 else None, f"n{r.randrange(38)}", None) for i in range(90)],
        ),
        "empty": (["x", "y"], []),
    }
    schemas = {
        "parents": "id LONG, name STRING, other INT",
        "children": "k INT, parent SMALLINT, name STRING, note STRING",
        "empty": "x LONG, y STRING",
    }
    tables = {t: spark.createDataFrame(rows, schemas[t]) for t, (_, rows) in made.items()}
    found = connections.find_connections(tables, least)
    assert sorted(map(tuple, found.collect())) == plain(made, least)


def test_more_columns_than_a_word_has_bits(spark, monkeypatch):
    monkeypatch.setattr(connections, "WORD", 3)
    wide = spark.createDataFrame([tuple(range(i, i + 8)) for i in range(20)], ", ".join(f"c{i} INT" for i in range(8)))
    one = spark.createDataFrame([(i,) for i in range(30)], "id INT")
    found = connections.find_connections({"wide": wide, "one": one})
    assert sorted(r["child_column"] for r in found.collect()) == [f"c{i}" for i in range(8)]


def test_nothing_that_could_be_a_key(spark):
    with pytest.raises(ValueError, match="no column"):
        connections.find_connections({"t": spark.createDataFrame([(1.5,)], "x DOUBLE")})


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("size", [4, 7, 100])
def test_all_pages_are_the_sorted_table(spark, descending, size):
    r = random.Random(size)
    data = [
        (r.choice([None, 1, 2, 3]), r.choice([None, "a", "b"]), r.choice([None, 0.5, float("nan")]))
        for _ in range(30)
    ]
    df = spark.createDataFrame(data, "k INT, name STRING, x DOUBLE").repartition(3)
    whole = [str(tuple(r)) for r in metrics.browse(df, "k", descending, hidden=()).collect()]
    pages, place = [], None
    while len(pages) <= len(whole) and (page := metrics.browse_page(df, "k", size, place, descending).collect()):
        place = metrics.place_of(page, place)
        pages += [str(tuple(r)) for r in page]
    assert pages == whole


def test_a_page_is_a_top_k_over_what_follows(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS k")
    df.write.mode("overwrite").saveAsTable("browse_test")
    saved = spark.table("browse_test")
    place = metrics.place_of(metrics.browse_page(saved, "k", 10).collect())
    text = metrics.browse_page(saved, "k", 10, place)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
    assert "GreaterThanOrEqual(k," in text
