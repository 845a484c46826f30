import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_fixtures import docs, none  # noqa: F401
from orrery.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def odd_texts():
    rng = random.Random(6)
    signs = ["a", "B", "é", "e\u0301", "ß", "İ", "Σ", "ς", "🙂", "\u200d", "中", "1", "½", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|", "\x00", "\x1c", "\x1d", "\x85", "\xa0", "\u2028", "\u3000", "\x0b", "\x0c", "\r\n", "\t", " ", " ", "\n", "-", "...", "\u0301"]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 200))) for _ in range(150)]


def corpus():
    rng = random.Random(7)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 10))) for _ in range(800)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = prose(900)
    out = [prose(300) + "\n" + passage + "\n" + prose(200 + k) for k in range(12)]
    return out + [out[0]] * 3 + [prose(5), "x" * 5000, "y " * 9000, None, "", "   ", passage]


def test_equal_to_the_library(spark, library):
    rows = list(enumerate(odd_texts() + corpus()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in bpe.encoded(df, PATH).collect()}
    assert len(got) == len(rows)
    for k, text in rows:
        ids, decoded = expected(library, text)
        assert np.frombuffer(got[k].ids, "<u4").tolist() == ids, k
        assert got[k].decoded == decoded, k


def test_chunks_are_cut_by_content():
    texts = [t.encode() for t in corpus() if t]
    chunks = bpe._chunks(texts)
    assert [b"".join(c) for c in chunks] == texts
    shared = set(chunks[0]) & set(chunks[1])
    assert shared and sum(map(len, shared)) > 2000
    assert bpe._chunks(texts[3:4]) == chunks[3:4]  # neighbours in a batch change nothing


def test_shared_chunks_are_encoded_once(spark):
    rows = [(k, t) for k, t in enumerate(corpus())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    counts = {r.key: r.n for r in bpe.chunk_counts(df).collect()}
    shared = spark.createDataFrame([(k,) for k, n in counts.items() if n > 1], "key binary")
    words = spark.sparkContext.broadcast(bpe._filter(shared))
    keys = [r.key for r in bpe._shared_ids(df, words, PATH).collect()]
    assert len(keys) == len(set(keys)) and set(keys) >= {k for k, n in counts.items() if n > 1}


def test_joins_that_disagree_are_seen():
    own, kept = bpe.Encoder(PATH), {}
    assert own.joins(b"two words ", b"and more", kept)
    assert not own.joins(b"brok", b"en", kept)


def test_a_full_filter_changes_nothing(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "FILTER_BITS", 6)
    rows = list(enumerate(corpus()))
    got = {r.doc_id: r for r in bpe.encoded(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()}
    assert all((np.frombuffer(got[k].ids, "<u4").tolist(), got[k].decoded) == expected(library, t) for k, t in rows)


def test_edge_cases(docs, none, library):
    rows = sorted(((r.doc_id or 0, r.text or "") for r in docs.collect()), key=str)
    found = bpe.encoded(docs.withColumn("ids", F.lit(1)).withColumn("key", F.lit(2)), PATH).collect()
    assert sorted((r.doc_id or 0, len(r.ids) // 4, r.decoded) for r in found) == sorted((k, len(expected(library, t)[0]), expected(library, t)[1]) for k, t in rows)
    assert bpe.encoded(none, PATH).count() == 0
