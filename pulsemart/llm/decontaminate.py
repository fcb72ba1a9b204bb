"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over the benchmark's words (others add nothing to a product with an
item), with document frequencies of the whole corpus. A randomised SVD of the benchmark's passages, computed over its rows in Spark, gives the latent
space. Passages of all documents are projected into it and compared with the benchmark's by
cosine; for candidates a longest common subsequence of words, and the answer where there is one,
decide. The latent space blurs rare words and short items, so a second key that follows from the
subsequence rule stands beside the cosine: of an item that needs k of its n words, any place that
has them has one of its rarest n - k + 1. No pair that passes the rule is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsemart.llm.common import new_name, saved, text_of

RANK = 64
ITERATIONS = 2
#: A passage of a document is 2 * HALF words, and starts every HALF words.
HALF = 32
#: Least cosine, and least share of an item's weight that a passage must hold, of a candidate.
COSINE = 0.30
HELD = 0.35
#: Share of an item's words that must occur in order close together.
COMMON = 0.60
#: The same where the item's answer occurs word for word beside it.
COMMON_WITH_ANSWER = 0.50
#: Items searched for in one pass over the documents; more take further passes, one index each.
ITEM_BLOCK = 20_000
#: Shortest item that says anything by itself.
LEAST_WORDS = 5


def words_of(text: str) -> list[str]:
    return text.lower().split()


def places_of(words: list[str], vocabulary: dict[str, int]) -> np.ndarray:
    """Number of each word in the vocabulary, -1 for others."""
    return np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int32, len(words))


def document_frequencies(docs: DataFrame, vocabulary: dict[str, int]) -> tuple[np.ndarray, int]:
    """In how many documents each word of the vocabulary occurs, and how many documents there are.

    Tasks add up their own rows; one row per word and task is shuffled.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for at in range(0, batch.num_rows, 500):
                for text in batch.column(0).slice(at, 500).to_pylist():
                    own = np.unique(places_of(words_of(text), vocabulary))
                    total[own[own >= 0]] += 1
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(own, -1)), pa.array(np.append(total[own], n))], ["place", "n"]
        )

    found = (
        docs.select(text_of("text").alias("text"))
        .mapInArrow(counted, "place long, n long")
        .groupBy("place")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most one row per word of the vocabulary
    )
    out = np.zeros(len(vocabulary) + 1, np.int64)
    for row in found:
        out[row["place"]] = row["n"]
    return out[:-1], int(out[-1])


def vectors(items: DataFrame, vocabulary: dict[str, int], idf: np.ndarray) -> DataFrame:
    """TF-IDF of items: features, weights."""

    def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, weights = [], []
            for text in batch.column(0).to_pylist():
                own, n = np.unique(places_of(words_of(text), vocabulary), return_counts=True)
                weight = n * idf[own]
                at.append(own.tolist())
                weights.append((weight / max(1e-9, float(np.linalg.norm(weight)))).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float32()))],
                ["features", "weights"],
            )

    return items.select("text").mapInArrow(weighted, "features array<int>, weights array<float>")


def randomised_svd(
    vectors: DataFrame, features: int, rank: int = RANK, iterations: int = ITERATIONS
) -> np.ndarray:
    """Right singular directions, features by rank, of the matrix with rows of feature, weight.

    `vectors` has features (array<int>) and weights (array<float>). Each pass multiplies the rows
    with the present directions in Spark, sums the products by feature and makes the result
    orthonormal; only features by rank numbers reach the driver.
    """
    basis = np.random.default_rng(7).standard_normal((features, rank)).astype(np.float32)
    for _ in range(iterations + 1):

        def products(
            batches: Iterator[pa.RecordBatch], basis: np.ndarray = basis
        ) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for at, weight in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                    weight = np.array(weight, np.float32)
                    row = weight @ basis[at]
                    for f, w in zip(at, weight, strict=True):
                        total[f] = total.get(f, 0) + w * row
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(total), pa.int32()),
                    pa.array([v.tolist() for v in total.values()], pa.list_(pa.float32())),
                ],
                ["feature", "product"],
            )

        sums = (
            vectors.select("features", "weights")
            .mapInArrow(products, "feature int, product array<float>")
            .groupBy("feature")
            .agg(
                F.array(*(F.sum(F.get("product", F.lit(i))) for i in range(rank))).alias("product")
            )
            .collect()  # at most one row per feature
        )
        image = np.zeros((features, rank))
        for row in sums:
            image[row["feature"]] = row["product"]
        # Orthonormal directions of the same span, the idle ones zero.
        values, turn = np.linalg.eigh(image.T @ image)
        scale = np.where(values > 1e-9 * max(values.max(), 1e-30), values, np.inf) ** -0.5
        basis = (image @ (turn * scale)).astype(np.float32)
    return basis


def common_length(one: Sequence, two: Sequence) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    places: dict = {}
    for i, x in enumerate(one):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(one)) - 1
    row = full
    for y in two:
        match = row & places.get(y, 0)
        row = (row + match | row - match) & full
    return len(one) - row.bit_count()


def holds(words: Sequence[str], answer: Sequence[str]) -> bool:
    n = len(answer)
    return bool(n) and any(words[i : i + n] == answer for i in range(len(words) - n + 1))


def needed(n: int, share: float) -> int:
    """How many of n words make the share."""
    return max(1, math.ceil(share * n - 1e-9))


def best_stretch(wanted: list[str], region: list[str], need: int) -> tuple[int, int]:
    """Most words of the item in order within little more than its length, and where (first).

    (0, 0) if fewer than `need`: what the whole region has, in any order or in order, bounds what
    any stretch of it can have. Every stretch of `reach(n)` words lies within one that is tried.
    """
    there = set(region)
    if sum(w in there for w in wanted) < need or common_length(wanted, region) < need:
        return 0, 0
    step = max(1, len(wanted) // 16)
    width = reach(len(wanted)) + step - 1
    best, at = 0, 0
    for begin in range(0, max(1, len(region) - width + step), step):
        length = common_length(wanted, region[begin : begin + width])
        if length > best:
            best, at = length, begin
    return (best, at) if best >= need else (0, 0)


def reach(n: int) -> int:
    """Over how many words an item of n words may be spread out."""
    return n + n // 4 + 4


class Index:
    """The benchmark's passages in the latent space, its rarest words, and the texts to check with."""

    def __init__(
        self,
        items: list[tuple],
        vocabulary: dict[str, int],
        counts: np.ndarray,
        idf: np.ndarray,
        basis: np.ndarray,
    ) -> None:
        self.items = [(i, words_of(t), words_of(a or "")) for i, t, a in items]
        self.vocabulary = vocabulary
        self.vectors = (basis * idf[:, None]).astype(np.float32)
        # An item longer than a document's passage is searched for by its parts.
        self.owner, parts, wholes = [], [], []
        rare: list[tuple[int, int]] = []
        for k, (_, words, answer) in enumerate(self.items):
            own = places_of(words, vocabulary)
            for at in range(0, max(1, len(own) - HALF), 2 * HALF):
                self.owner.append((k, at))
                parts.append(self.vectors[own[at : at + 2 * HALF]].sum(0))
            wholes.append(self.vectors[own].sum(0))
            spare = len(own) - self.need(k)
            rarest = own[np.lexsort((own, counts[own]))][: spare + 1]
            rare += [(w, k) for w in np.unique(rarest).tolist()]
        none = np.zeros((0, basis.shape[1]), np.float32)
        self.parts = np.stack(parts) if parts else none
        self.wholes = np.stack(wholes) if wholes else none
        self.norms = np.linalg.norm(self.parts, axis=1) + 1e-9
        # The items by their rarest words: those of word w are holders[starts[w] : starts[w + 1]].
        rare.sort()
        self.holders = np.array([k for _, k in rare], np.int64)
        self.starts = np.searchsorted([w for w, _ in rare], np.arange(len(vocabulary) + 1))
        self.reach = np.array([reach(len(words)) for _, words, _ in self.items], np.int64)

    def need(self, k: int) -> int:
        """Least number of common words that can make item k a leak."""
        _, words, answer = self.items[k]
        return needed(len(words), COMMON_WITH_ANSWER if answer else COMMON)

    def near(self, sizes: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Candidates by cosine as text, passage, part; texts are laid out one after the other."""
        base = np.cumsum(np.concatenate([[0], sizes // HALF + 2]))
        begin = np.cumsum(sizes) - sizes
        half = np.repeat(base[:-1], sizes) + (np.arange(len(places)) - np.repeat(begin, sizes)) // HALF
        there = places >= 0
        half, places = half[there], places[there]
        if not len(half) or not len(self.parts):
            return
        halves = np.zeros((base[-1] + 1, self.vectors.shape[1]), np.float32)
        first = np.flatnonzero(np.concatenate([[True], half[1:] != half[:-1]]))
        halves[half[first]] = np.add.reduceat(self.vectors[places], first, axis=0)
        passages = halves[:-1] + halves[1:]
        lengths = np.linalg.norm(passages, axis=1) + 1e-9
        step = max(1, 4_000_000 // len(self.parts))
        for at in range(0, len(passages), step):
            dots = passages[at : at + step] @ self.parts.T
            for p, part in zip(*np.nonzero(dots >= HELD * self.norms**2), strict=True):
                if dots[p, part] >= COSINE * lengths[at + p] * self.norms[part]:
                    text = int(np.searchsorted(base, at + p, "right")) - 1
                    yield text, int(at + p - base[text]), int(part)

    def with_rare(self, sizes: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Candidates by a rare word as text, item, and which stretch of the item's reach it is in."""
        at = np.flatnonzero(places >= 0)
        first = self.starts[places[at]]
        n = self.starts[places[at] + 1] - first
        at, first, n = at[n > 0], first[n > 0], n[n > 0]
        if not len(at):
            return
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item = self.holders[np.repeat(first, n) + within]
        ends = np.cumsum(sizes)
        text = np.searchsorted(ends, at, "right")
        place = np.repeat(at - (ends - sizes)[text], n)
        key = (np.repeat(text, n) * len(self.items) + item) << 32 | place // self.reach[item]
        for x in np.unique(key).tolist():
            text_and_item, stretch = x >> 32, x & 0xFFFFFFFF
            yield text_and_item // len(self.items), text_and_item % len(self.items), stretch

    def regions(self, sizes: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Where to look for what: text, item, begin, end."""
        for text, passage, part in self.near(sizes, places):
            k, at = self.owner[part]
            n = len(self.items[k][1])
            # The whole item, wherever in it the part found stands, and a few words inserted.
            slack = HALF + n // 4
            begin = max(0, passage * HALF - at - slack)
            yield text, k, begin, passage * HALF + 2 * HALF + n - at + slack
        for text, k, stretch in self.with_rare(sizes, places):
            # All that can lie within the item's reach of a word of the stretch.
            width = int(self.reach[k])
            yield text, k, max(0, (stretch - 1) * width + 1), (stretch + 2) * width - 1

    def search(self, texts: list[str]) -> list[list[dict]]:
        """For each text the items that it holds, each with its best place (in words)."""
        split = [words_of(t) for t in texts]
        sizes = np.array([len(t) for t in split], np.int64)
        places = places_of(list(chain.from_iterable(split)), self.vocabulary)
        begins = np.cumsum(sizes) - sizes
        best: list[dict[int, dict]] = [{} for _ in texts]
        for text, k, begin, end in self.regions(sizes, places):
            item, wanted, answer = self.items[k]
            n = len(wanted)
            length, at = best_stretch(wanted, split[text][begin:end], self.need(k))
            if not length or (k in best[text] and length / n <= best[text][k]["common"]):
                continue
            beside = 2 * HALF + n + len(answer)
            answered = holds(split[text][max(0, begin - beside) : end + beside], answer)
            if answered or length >= needed(n, COMMON):
                place = begin + at
                there = places[begins[text] + place :][: min(reach(n), sizes[text] - place)]
                vector = self.vectors[there[there >= 0]].sum(0)
                norms = np.linalg.norm(vector) * np.linalg.norm(self.wholes[k]) + 1e-9
                best[text][k] = {
                    "item_id": item,
                    "common": length / n,
                    "cosine": float(vector @ self.wholes[k] / norms),
                    "answer": answered,
                    "place": place,
                }
        return [list(b.values()) for b in best]


FOUND = "array<struct<item_id:long,common:double,cosine:double,answer:boolean,place:long>>"


def indexes(docs: DataFrame, benchmark: DataFrame) -> Iterator[Index]:
    """An index for each block of items.

    `benchmark` has item_id and text, and may have answer. Items of fewer than five words (null
    ones too) are not searched for; without items there is no index.
    """
    no_answer = F.lit(None).cast("string")
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else no_answer
    items = saved(
        benchmark.select(
            F.col("item_id").cast("long").alias("item_id"),
            text_of("text").alias("text"),
            answer.alias("answer"),
        ).where(F.size(F.array_remove(F.split("text", r"\s+"), "")) >= LEAST_WORDS),
        "items",
    )
    n_blocks = -(-items.count() // ITEM_BLOCK)
    for block in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        found = [tuple(r) for r in own.collect()]  # the query set of this block
        words = dict.fromkeys(chain.from_iterable(words_of(t) for _, t, _ in found))
        vocabulary = {w: i for i, w in enumerate(words)}
        counts, n_docs = document_frequencies(docs, vocabulary)
        idf = (np.log((n_docs + 1.0) / (counts + 1.0)) + 0.1).astype(np.float32)
        # From files: two steps of Python in one task would take two workers, which stay.
        weighted = saved(vectors(own, vocabulary, idf), "vectors")
        basis = randomised_svd(weighted, len(vocabulary))
        yield Index(found, vocabulary, counts, idf, basis)


def search(docs: DataFrame, index: Index | None, keep: Sequence[str]) -> DataFrame:
    """row (a struct of the `keep` columns) and leaks, one row per row of documents.

    Words are split at white space in lower case. A null text is empty and holds nothing. Repeated
    items are all reported. An index holds a block's texts, words and directions, which is all that
    a task holds of the benchmark; without one there are no leaks.
    """

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct(
                [
                    ("item_id", pa.int64()),
                    ("common", pa.float64()),
                    ("cosine", pa.float64()),
                    ("answer", pa.bool_()),
                    ("place", pa.int64()),
                ]
            )
        )
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = part.column(1).to_pylist()
                leaks = index.search(texts) if index else [[]] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(leaks, kind)], ["row", "leaks"]
                )

    rows = docs.select(F.struct(*keep).alias("row"), text_of("text").alias("text"))
    schema = rows.select("row").schema.add("leaks", StructType.fromDDL(f"leaks {FOUND}")[0].dataType)
    return rows.mapInArrow(searched, schema)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, common, cosine, answer, place for every item that a document holds."""
    passes = [search(docs, i, ["doc_id"]) for i in indexes(docs, benchmark)]
    found = reduce(DataFrame.unionAll, passes) if passes else search(docs, None, ["doc_id"])
    return found.select("row.doc_id", F.inline("leaks"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with the same columns."""
    every = list(indexes(docs, benchmark))
    if len(every) < 2:
        found = search(docs, every[0] if every else None, docs.columns)
        return found.where(F.size("leaks") == 0).select("row.*")
    # Each block by itself tells the texts that hold one of its items.
    key = F.sha2(text_of("text"), 256)
    texts = docs.select(key.alias("held"), "text")
    passes = [search(texts, i, ["held"]).where(F.size("leaks") > 0) for i in every]
    held = reduce(DataFrame.unionAll, passes).select("row.held").distinct()
    name = new_name(docs.columns, "held")
    return docs.join(held.withColumnRenamed("held", name), key == F.col(name), "left_anti")
