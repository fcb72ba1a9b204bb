from collections import Counter

import corpus_pipeline
from pulsemart.llm import queries
import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.saved(stage(spark, docs, SF), name)
        assert after.dtypes == docs.dtypes, name
        ids = Counter(r["doc_id"] for r in after.select("doc_id").collect())
        assert set(ids.values()) == {1}
        assert set(ids) <= {r["doc_id"] for r in docs.select("doc_id").collect()}
        sizes.append(len(ids))
        docs = after
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > sizes[4] > 50
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in last} == set(ids)
    whole = corpus_pipeline.run(spark, SF).collect()
    key = lambda rows: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows)
    assert key(whole) == key(last)


def test_registered():
    assert set(queries.QUERIES) < set(entry_points.queries()) and "pipeline" in entry_points.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
