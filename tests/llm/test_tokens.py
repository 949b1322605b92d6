"""Token counts and packing against the vocabulary file's own library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from wattfold.llm import packing, token_counts, tokens
from wattfold.llm.common import TOKENIZER
from wattfold.session import scratch_dir

TEXTS = ["", None, "Hello  world\n\n don't 123", "<|endoftext|>a<|endoftext|>", "é漢😀‍́ \xa0x", "a" * 5000, " " * 3000]


@pytest.fixture(scope="module")
def own():
    return tokenizers.Tokenizer.from_file(TOKENIZER)


def ids(own, text):
    return own.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_library(own):
    draw = random.Random(3)
    letters = " \t\n　ab'stAZ09.,<|endoftext|>é漢😀‍́\r"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(60))) for _ in range(500)]
    got = tokens.encoder(TOKENIZER)(texts)
    assert [list(g) for g in got] == [ids(own, t) for t in texts]


def docs(spark, texts, first=0):
    rows = [(first + i, t, f"x{i}", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, start int")


def test_counts_fill_and_use_the_cache(spark, own):
    cache = f"{scratch_dir(spark, 'test-cache')}/counts"
    table = docs(spark, TEXTS + TEXTS + ["again"] * 50)
    got = {r.doc_id: r for r in token_counts.count_tokens(table, cache).collect()}
    assert len(got) == table.count()
    for r in table.collect():
        assert got[r.doc_id].n_tokens == len(ids(own, r.text))
        assert got[r.doc_id].n_bytes == len((r.text or "").encode())
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for t in TEXTS}) + 1
    token_counts.count_tokens(docs(spark, TEXTS[:3] + ["new"]), cache).collect()
    assert spark.read.parquet(cache).count() == len({t or "" for t in TEXTS}) + 2


def test_counts_of_nothing(spark):
    cache = f"{scratch_dir(spark, 'test-cache')}/counts"
    assert token_counts.count_tokens(docs(spark, ["x"]).where("false"), cache).count() == 0


def test_sentencepiece_counts(spark):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    want = sentencepiece.SentencePieceProcessor(model_file=path).encode("Hello world")
    got = token_counts.count_tokens(docs(spark, ["Hello world"]), f"{scratch_dir(spark, 'c')}/x", path)
    assert got.first().n_tokens == len(want)


def check_packing(pieces, streams):
    where, covered = defaultdict(list), defaultdict(list)
    for r in pieces:
        stream = streams[r.doc_id]
        assert r.doc_tokens == len(stream)
        assert bytes(r.ids) == stream[r.start : r.start + r.length].tobytes()
        where[r.sequence_id].append((r.offset, r.length))
        covered[r.doc_id].append((r.start, r.length))
    for spans in where.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    for doc, spans in covered.items():
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == len(streams[doc])
    assert set(covered) == set(streams)
    return len(where)


def test_packing_is_an_exact_round_trip(spark, own):
    draw = random.Random(5)
    texts = TEXTS + [" ".join(draw.choice("of the tion ing alpha beta".split()) for _ in range(draw.randrange(1, 3000))) for _ in range(150)]
    streams = {i: np.array(ids(own, t) + [0], "<u4") for i, t in enumerate(texts)}
    found = packing.pack(docs(spark, texts).repartition(5)).collect()
    sequences = check_packing(found, streams)
    assert sum(map(len, streams.values())) / (1024 * sequences) > 0.97
    crc = packing.digests(packing.cut(docs(spark, texts[:9]))).collect()
    assert all(r.ids_crc32 == zlib.crc32(streams[r.doc_id][r.start : r.start + r.length].tobytes()) for r in crc)


def test_packing_of_nothing_nulls_and_repeats(spark):
    assert packing.pack(docs(spark, ["x"]).where("false")).count() == 0
    rows = packing.pack(docs(spark, [None, ""]).withColumn("doc_id", F.lit(None).cast("bigint"))).collect()
    assert [(r.doc_id, r.length, bytes(r.ids)) for r in rows] == [(None, 1, b"\0\0\0\0")] * 2


def test_differencing_keeps_every_size_and_balances():
    draw = np.random.default_rng(1)
    for _ in range(20):
        sizes = draw.integers(1, 257, draw.integers(1, 400))
        window = packing.balanced_windows(sizes, 1024)
        sums = np.bincount(window, weights=sizes)
        assert len(window) == len(sizes) and sums.max() <= 1024
    sums, window = packing.differencing(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(window, weights=[8, 7, 6, 5, 4])) == sorted(sums) == [14, 16]
