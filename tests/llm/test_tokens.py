import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pulsemart.llm import grammar, packing, tokens
from pulsemart.llm.tokens import BYTE_PIECES, WORD_PIECES, Encoder

SCHEMA = "doc_id long, text string, n_words long, piece string"
ODD = [
    "",
    " ",
    "\n\n a  b\n\tc \n",
    "don't we'll 'S x's",
    "a b  c　d e\x85f\x1cg\x1dh",
    "é é ́x İSTANBUL ΣΑΣ ſ ﬁ 数字12 ½ ١٢",
    "<|endoftext|> <|startoftext|> a<|endoftext|>b",
    "😀😀 👩‍👩‍👧 ﻿ ​ zero",
    "#" * 5000,
    "x" * 3000 + " " * 3000 + "y",
    "Straße ÀÉÎ ÿþ ß. À, é́ é. a.b ,c d.,e. word, Word. word., wordé. ÷ × ª",
    "one!!! two&&& three$$$ four%% a-b c_d e`f (g) [h] {i} j~k l'm'n o's p'' q/r s\\t u|v w<x y>z =a+ b^ c*",
    " lead trail \n word\n word.\tÜber,",
]


def random_texts(n):
    r = random.Random(5)
    alphabet = "ab éß1½'s \n\t  .,!#<|>ΣÍ"
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize(
    "name, pieces", [("byte_bpe_50k.json", BYTE_PIECES), ("word_bpe_49k.json", WORD_PIECES)]
)
def test_pieces_give_the_ids_of_whole_texts(name, pieces, monkeypatch):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    texts = ODD + random_texts(400)
    want = [whole.encode(text, add_special_tokens=False).ids + [7] for text in texts]
    ours = Encoder(path, pieces, most=20)
    assert [ids.tolist() for ids in ours.encode(texts, 7)] == want
    # Arrow arrays that start amid others, in slices of a few bytes.
    monkeypatch.setattr(tokens, "SLICE_BYTES", 100)
    for kind in (pa.string(), pa.large_string()):
        part = pa.array(texts, kind).slice(3, 200)
        assert [ids.tolist() for ids in ours.encode(part, 7)] == want[3:203]
    assert list(ours.encode([], 7)) == []


def test_new_words_meet_the_model_together_and_apart_from_their_marks(monkeypatch):
    """One call for each of 2,000 words, and for each word with a mark, took most of the time."""
    path, calls = public_tokenizers.path("byte_bpe_50k.json"), []
    ours = Encoder(path, BYTE_PIECES)
    r = random.Random(8)
    words = ["".join(r.choice("abcdefgh") for _ in range(9)) for _ in range(2000)]
    texts = [" ".join(words), " ".join(w + r.choice(".,;!-") for w in words), "-".join(words)]
    of_words = ours.of_words
    monkeypatch.setattr(ours, "of_words", lambda own: calls.extend(own) or of_words(own))
    found = [ids.tolist() for ids in ours.encode(texts, 2)]
    whole = Tokenizer.from_file(path)
    assert found == [whole.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    # Each word with a blank and without; the model is asked for 100 at a time.
    assert len(calls) == len(set(calls)) <= 4000 and ours.gap_id is not None


def token_rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [(i, t, i, None) for i, t in enumerate(ODD + random_texts(40))] + [
    (None, "no number", 1, "x"),
    (3, ODD[3], 3, None),
    (3, ODD[3], 3, None),
    (77, None, None, None),
]


def test_token_files_round_trip(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    files = grammar.write_files(token_rows(spark, ROWS), path, 2, 50_257, shard_ids=500)
    got = grammar.read_documents(files).collect()
    whole = Tokenizer.from_file(path)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for doc, text, *_ in order:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    for row in files.collect():
        shard = grammar.Shard.read(row["data"])
        ids, at = shard.all_ids(), 0
        for k, size in enumerate(shard.sizes):
            assert (shard.document(k) == ids[at : at + size]).all()
            at += size


def test_token_files_of_an_empty_table(spark):
    files = grammar.write_files(
        token_rows(spark, []), public_tokenizers.path("byte_bpe_50k.json"), 2, 50_257
    )
    assert grammar.read_documents(files).collect() == []


def test_grammar_shrinks_and_restores():
    r = np.random.default_rng(3)
    words = [r.integers(0, 50_000, 6) for _ in range(50)]
    docs = [np.concatenate([words[i] for i in r.integers(0, 50, 40)]).astype("<u4") for _ in range(60)]
    docs += [np.array([5] * 999, "<u4"), np.array([2], "<u4")]
    data = grammar.write_shard(list(range(62)), docs, 50_257)
    shard = grammar.Shard.read(data)
    assert (shard.all_ids() == np.concatenate(docs)).all()
    assert len(shard.seq) < 0.4 * sum(map(len, docs))


def test_grammar_goes_on_until_copies_are_one_symbol():
    r = np.random.default_rng(4)
    passage = r.integers(0, 50_000, 600).astype("<u4")
    docs = [np.concatenate([passage, r.integers(0, 50_000, 3).astype("<u4")]) for _ in range(300)]
    data = grammar.write_shard(list(range(300)), docs, 50_257)
    shard = grammar.Shard.read(data)
    assert len(shard.seq) < 8 * 300  # three ids of its own and few symbols for the passage
    for k in (0, 7, 299):
        assert (shard.document(k) == docs[k]).all()
    whole = grammar.expansions(shard.first, shard.rules)
    ends = np.cumsum(shard.lengths)
    for k, (a, b) in enumerate(shard.rules.tolist()):
        parts = [
            np.array([x]) if x < shard.first else whole[ends[x - shard.first] - shard.lengths[x - shard.first] : ends[x - shard.first]]
            for x in (a, b)
        ]
        assert (whole[ends[k] - shard.lengths[k] : ends[k]] == np.concatenate(parts)).all()


@pytest.mark.parametrize("ids", [[2], [5] * 1001, [1, 2] * 501, [70_000] * 40, list(range(30))])
def test_grammar_of_odd_shards(ids):
    docs = [np.array(ids, "<u4"), np.array([2], "<u4")]
    for first in (80_000, 70_001):  # no room for rules in 16 bits
        shard = grammar.Shard.read(grammar.write_shard([None, 1], docs, first))
        assert (shard.all_ids() == np.concatenate(docs)).all()
    if max(ids) < 50_257:
        shard = grammar.Shard.read(grammar.write_shard([None, 1], docs, 50_257))
        assert (shard.document(0) == docs[0]).all() and (shard.document(1) == docs[1]).all()


def check_packing(rows, size):
    by = {}
    for row in rows:
        by.setdefault(row["sequence_id"], []).append(row)
    for found in by.values():
        found.sort(key=lambda r: r["offset"])
        at = 0
        for row in found:
            assert row["offset"] == at
            at += row["length"]
        assert at <= size
    return len(by)


def test_packing(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.cut(token_rows(spark, ROWS), path, 0, 64, with_ids=True)
    got = packing.pack(pieces, 64).collect()
    total = sum(r["length"] for r in got)
    assert check_packing(got, 64) <= -(-total // 64) + 2
    whole = Tokenizer.from_file(path)
    want = []
    for doc, text, *_ in ROWS:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[at : at + 64], "<u4").tobytes()
            want.append((doc or -1, k, at, len(part) // 4, zlib.crc32(part)))
    assert sorted((r[0] or -1, *r[1:5]) for r in got) == sorted(want)
    assert packing.pack(packing.cut(token_rows(spark, []), path, 0, 64), 64).collect() == []


@pytest.mark.parametrize("score", ["residual", "dot"])
def test_every_capacity_holds(score):
    r = np.random.default_rng(1)
    length = r.integers(1, 90, 400)
    demands = np.stack([length, np.ones_like(length), length**2], 1)
    bins = packing.best_fit(demands, (100, 4, 6000), (1.0, 0.5, 0.5), score)
    for b in np.unique(bins):
        own = demands[bins == b].sum(0)
        assert (bins == b).sum() == 1 or (own <= (100, 4, 6000)).all()
    exact = packing.best_fit(demands[:, :1], (100,), (1.0,))
    assert exact.max() + 1 <= 1.05 * -(-length.sum() // 100)


def test_texts_travel_to_be_cut_in_small_batches(spark):
    """10,000 texts at a time held tens of MB for each task, in the worker and outside the heap."""

    def sizes(batches):
        for batch in batches:
            row = {"doc_id": batch.num_rows, "piece": 0, "start": 0, "length": 1, "ids_crc32": 0, "salt": 0, "ids": None}
            yield pa.RecordBatch.from_pylist([row], schema)

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "salt", "ids"]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    pieces = spark.range(0, 5000, 1, 1).mapInArrow(
        sizes, "doc_id long, piece int, start long, length long, ids_crc32 long, salt long, ids binary"
    )
    found = [r["doc_id"] for r in packing.pack(pieces, 2048).collect()]
    assert sum(found) == 5000 and max(found) <= 2000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
