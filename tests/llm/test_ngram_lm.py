import math
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import docs, none  # noqa: F401
from orrery.llm import ngram_lm


def brute(rows):
    """Scores by string counts, leaving each document's own counts out."""
    words = [(i, (t or "").encode().lower().split()) for i, t in rows]
    one, two = Counter(), Counter()
    for _, w in words:
        one.update(w)
        two.update(zip(w, w[1:], strict=False))
    total = sum(one.values())
    out = []
    for i, w in words:
        own1, own2 = Counter(w), Counter(zip(w, w[1:], strict=False))
        score, seen = 0.0, 0
        for k, x in enumerate(w):
            pair = (w[k - 1], x) if k else None
            if pair and two[pair] > own2[pair]:
                score += math.log((two[pair] - own2[pair]) / (one[w[k - 1]] - own1[w[k - 1]]))
                seen += 1
            else:
                score += math.log((ngram_lm.BACKOFF if k else 1) * max(one[x] - own1[x], ngram_lm.BACKOFF) / max(total - len(w), 1))
        out.append((i, len(w), seen, round(score, 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "bucket"), [(400_000, 2_000_000), (40, 25)])
def test_agrees_with_string_counts(spark, block, bucket):
    rows = [(k, " ".join(f"W{(k * j + j * j) % 23}" for j in range(k % 40))) for k in range(80)]
    rows += [(7, rows[7][1]), (200, "the " * 3000), (201, None), (None, "null id w1"), (202, " \t")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_lm.scored(df, words_per_block=block, ngrams_per_bucket=bucket).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_seen, round(r.score, 6)) for r in got), key=str) == brute(rows)
    assert all((r.mean_score is None) == (r.n_words == 0) for r in got)


def test_familiar_text_scores_higher(spark):
    rows = [(k, "the cat sat on the mat and the dog lay by the door") for k in range(20)] + [(100, "mat the on sat cat the by lay dog the and door"), (101, "qua wex yot zib nuv kel pim gro")]
    got = {r.doc_id: r.mean_score for r in ngram_lm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] > got[100] > got[101]


def test_packing_keeps_counts():
    for counts in ([], [0, 1, 254, 255, 256, 10**12], [255] * 3):
        assert ngram_lm._unpacked(ngram_lm._packed(np.array(counts, np.int64))).tolist() == counts


def test_packing_keeps_keys():
    rng = np.random.default_rng(3)
    for keys in ([], [0], [5, 2**64 - 1], [2**48 - 1, 2**49], rng.integers(0, 2**63, 1000).tolist()):
        keys = np.unique(np.array(keys, np.uint64))
        assert (ngram_lm._unpacked_keys(ngram_lm._packed_keys(keys)) == keys).all()


def test_edge_cases(docs, none):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = ngram_lm.scored(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_seen, round(r.score, 4)) for r in got), key=str) == [(*x[:3], round(x[3], 4)) for x in brute(rows)]
    assert ngram_lm.scored(none).count() == 0
