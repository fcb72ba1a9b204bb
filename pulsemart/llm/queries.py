"""The operators as queries over the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.llm import (
    centroids,
    chat,
    chunk_reuse,
    decontaminate,
    grammar,
    html_text,
    lm_scoring,
    ngram_join,
    packing,
    periods,
    quality_rules,
    repeats,
    url_rules,
)
from pulsemart.llm.common import table

DOMAIN_RULES = (
    url_rules.DomainRule("allow", "com"),
    url_rules.DomainRule("block", "example.com", "/en/"),
    url_rules.DomainRule("allow", "www.example.com", "/en/"),
    url_rules.DomainRule("block", "net", "/es/"),
    url_rules.DomainRule("block", "net", "/fr/"),
)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of near duplicates of every document."""
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds."""
    return decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from the formatted conversations."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema
    )
    done = chat.format_conversations(rows.unionByName(extra))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns, masked = chat.parse(text), []
                for role, span in zip(row["roles"], row["text_spans"], strict=True):
                    if role == "assistant" and span:
                        masked.append(chat.unescaped(text[span["start"] : span["end"]]))
                loss = "".join(masked)
                whole = "".join(f"{t['role']}\n{t['text']}\n" for t in turns)
                out.append(
                    {
                        "conv_id": row["conv_id"],
                        "n_turns": len(turns),
                        "turns_sha256": hashlib.sha256(whole.encode()).hexdigest(),
                        "loss_chars": len(loss),
                        "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
                        "formatted_chars": len(text),
                        "rewrites": row["rewrites"],
                    }
                )
            schema = pa.schema(
                [
                    ("conv_id", pa.int64()),
                    ("n_turns", pa.int64()),
                    ("turns_sha256", pa.string()),
                    ("loss_chars", pa.int64()),
                    ("loss_sha256", pa.string()),
                    ("formatted_chars", pa.int64()),
                    ("rewrites", pa.bool_()),
                ]
            )
            yield pa.RecordBatch.from_pylist(out, schema)

    return done.mapInArrow(
        digests,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, rewrites boolean",
    )


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's url; labels of the same number tell bad pages."""
    pages = table(spark, sf_dir, "pages")
    labels = (
        table(spark, sf_dir, "labels")
        .groupBy("doc_id")
        .agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    )
    labelled = pages.join(labels, F.col("page_id") == F.col("doc_id")).select("url", "bad")
    mined = url_rules.mine_rules(labelled)
    return url_rules.judge(pages, mined, DOMAIN_RULES, keep=["page_id"])


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs).select(
        "doc_id", *quality_rules.STATS, "base_failed", "kept", "distance"
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document under the n-grams, of up to five words, of all others."""
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as compressed token files, read back."""
    files = grammar.write_files(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        end=2,
        first=50_257,
    )
    return grammar.read_documents(files)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    pieces = packing.cut(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        end=0,
        size=2048,
    )
    return packing.pack(pieces, 2048).drop("ids")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses of strings of 400 bytes that start twice."""
    return repeats.remove(table(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds from sixteen first centroids."""
    return centroids.assign(table(spark, sf_dir, "embeddings"))


def op12_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document, and the text that they decode to."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    coded = chunk_reuse.encode(table(spark, sf_dir, "documents"), tokenizer)
    shown = coded.select(
        "doc_id",
        F.floor(F.length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        "ids",
    )
    return chunk_reuse.decode(shown, tokenizer).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, and its text without their repetitions."""
    docs = table(spark, sf_dir, "documents")
    return periods.digests(periods.collapse(docs, prepare=periods.with_planted_run))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_decontamination": op2_decontamination,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_url_filters": op4_url_filters,
    "op5_quality_rules": op5_quality_rules,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_html_extraction": op7_html_extraction,
    "op8_token_files": op8_token_files,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_bpe_chunk_reuse": op12_bpe_chunk_reuse,
    "op13_periodic_runs": op13_periodic_runs,
}


def _rounds(n: int) -> str:
    """Assignments a0, a1, ... and the centroids c1, c2, ... they lead to, as common tables."""
    steps = []
    for r in range(n + 1):
        steps.append(f"""
        a{r} AS (
          SELECT row, arg_min(k, (distance, k)) AS k, min(distance) AS distance
          FROM (SELECT row, k, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance
                FROM v JOIN c{r} c USING (j) GROUP BY row, k)
          GROUP BY row)""")
        steps.append(f"""
        c{r + 1} AS (
          SELECT c.k, c.j, coalesce(m.x, c.x) AS x
          FROM c{r} c LEFT JOIN (
            SELECT k, j, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x
            FROM v JOIN a{r} USING (row) GROUP BY k, j) m USING (k, j))""")
    return ",".join(steps[:-1])


ORACLES: dict[str, str] = {
    "op11_centroid_clustering": f"""
        WITH kept AS (
          SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
          WHERE len(embedding) = 64
            AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
        v AS (
          SELECT row, j, CAST(floor(64 * CAST(embedding[j] AS DOUBLE)) AS BIGINT) AS x
          FROM kept, range(1, 65) AS t(j)),
        firsts AS (
          SELECT row, row_number() OVER (ORDER BY sha256('1:' || vec_id), row) - 1 AS k
          FROM kept WHERE vec_id IS NOT NULL),
        c0 AS (SELECT k, j, x FROM firsts JOIN v USING (row) WHERE k < 16),
        {_rounds(3)},
        digests AS (
          SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS digest
          FROM c3 GROUP BY k)
        SELECT vec_id, CAST(k AS INTEGER) AS cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
        FROM a3 JOIN kept USING (row) JOIN digests USING (k)""",
}
