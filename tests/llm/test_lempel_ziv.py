import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from llm_fixtures import docs, none  # noqa: F401
from orrery.llm import lempel_ziv as lz
from orrery.llm.common import table


def brute(rows, window=13):
    """Every window as a tuple of words."""
    last = float("inf")
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, last), last if i is None else i)
    out = []
    for i, w in words:
        at = last if i is None else i
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < at for j in range(window)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in (df.columns[0], "n_words", "n_removed", "kept_sha256")) for r in df.collect()), key=str)


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_agrees_with_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    want = brute([(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()])
    got = lz.op12(spark, folder)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert result(got) == want and any(r[2] for r in want)


def test_sql_agrees(spark):
    folder = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS FROM '{folder}/documents.parquet'")
    assert sorted(duckdb.sql(lz.OP12_SQL).fetchall(), key=str) == result(lz.op12(spark, folder))


@pytest.mark.parametrize(("window", "width", "block", "task", "piece"), [(13, 7, 200_000, 2_000_000, 512), (13, 7, 40, 60, 16), (5, 2, 30, 50, 3), (4, 4, 1000, 20, 40)])
def test_passages_in_every_position(spark, monkeypatch, window, width, block, task, piece):
    """Copies that begin and end anywhere, overlap, come from several documents and differ by single words."""
    monkeypatch.setattr(lz, "PIECE_WORDS", piece)
    rng = random.Random(window + piece)
    passages = [prose(rng, rng.randrange(3, 60)) for _ in range(12)]
    rows = []
    for k in range(150):
        words = []
        for _ in range(rng.randrange(5)):
            words += prose(rng, rng.randrange(12))
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            p = p[a : a + rng.randrange(1, 60)]
            if p and rng.random() < 0.4:
                p = p.copy()
                p[rng.randrange(len(p))] = "changed"
            words += p
        rows.append((rng.randrange(10_000), " ".join(words)))
    rows += [(20_000 + k, rows[k][1]) for k in range(0, 150, 3)]  # copies behind
    rows += [(rows[3][0], rows[4][1]), (rows[5][0], rows[5][1]), (None, rows[6][1]), (None, rows[6][1] + " x")]
    rows += [(30_000 + k, "a b " * 50 + "c") for k in range(3)] + [(40_000, "a b " * 49), (50_000, "same " * 200), (50_001, "same " * 14)]
    got = lz.parsed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), window=window, width=width, block_words=block, task_words=task)
    want = brute(rows, window)
    assert result(got) == want
    assert 0 < sum(r[2] for r in want) < sum(r[1] for r in want)


def test_a_window_that_the_first_holder_of_its_anchor_lacks(spark):
    """Documents 1 and 2 share a passage; document 0 has each of its anchors, but among other words."""
    rng = random.Random(4)
    passage = prose(rng, 30, 10**6)
    hashes, _ = lz.hashed_words([" ".join(passage)])
    scattered = [prose(rng, 15, 10**6) + passage[p : p + lz.ANCHOR] for p in lz.anchors(hashes, 13, 7)[0]]
    text = " ".join(passage)
    rows = [(0, " ".join(w for s in scattered for w in s)), (1, " ".join(prose(rng, 40, 10**6)) + " " + text), (2, text + " " + " ".join(prose(rng, 40, 10**6)))]
    got = {r.doc_id: r for r in lz.parsed(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(got[k].n_removed, got[k].spans) for k in (0, 1)] == [(0, None), (0, None)]
    assert [tuple(s) for s in got[2].spans] == [(0, 30)] and got[2].kept == " ".join(rows[2][1].split()[30:])
    assert result(lz.parsed(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


@pytest.mark.parametrize("at_once", [1 << 21, 20, 1])
def test_hashes_of_words(monkeypatch, at_once):
    monkeypatch.setattr(lz, "BYTES_AT_ONCE", at_once)
    rng = random.Random(at_once)
    texts = [None, "", " \n", "one", " two  words\t"] + ["".join(rng.choice("aé b\n🙂") for _ in range(rng.randrange(60))) for _ in range(200)]
    words = [(t or "").encode().split() for t in texts]
    hashes, sizes = lz.hashed_words(texts)
    assert sizes.tolist() == [len(w) for w in words] and len(hashes) == sum(sizes)
    by_word = {}
    for w, h in zip((x for own in words for x in own), hashes.tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_anchors_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 9, n, np.uint64) for n in (0, 3, 6, 40, 5, 0, 100, 7)]
    at, keys = lz.anchors(np.concatenate(texts), 6, 3, np.array([len(t) for t in texts]))
    want, base = [], 0
    for t in texts:
        want += [(base + p, h) for p, h in zip(*(x.tolist() for x in lz.anchors(t, 6, 3)), strict=True)]
        base += len(t)
    assert list(zip(at.tolist(), keys.tolist(), strict=True)) == want


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 4, 400, np.uint64)
    at, keys = lz.anchors(words, 6, 3)
    for k in range(len(words) - 5):
        own = set(lz.anchors(words[k : k + 6], 6, 3)[1].tolist())
        assert own and own <= set(keys[(at >= k) & (at <= k + 3)].tolist())
    assert len(lz.anchors(words[:5], 6, 3)[0]) == 0


def test_factors_are_as_long_as_the_words_agree():
    a = np.arange(100, dtype=np.uint64) * np.uint64(77)
    block = lz.Block([(7, a[:60]), (3, a[40:90])], 13)
    spans, rest = block.factors(9, np.concatenate([a[10:50], a[95:99], a[45:80]]))
    assert spans == [(0, 40), (44, 79)]
    assert rest.tolist() == list(range(28, 44))
    assert block.factors(5, a[:60])[0] == [(40, 60)]  # only the piece of document 3 is earlier
    assert block.factors(3, a)[0] == [] and lz.Block([], 13).factors(9, a)[0] == []


def test_spans_name_what_goes(spark):
    rng = random.Random(9)
    rows = [(k, " ".join(prose(rng, 100) + ["the"] * (k % 20))) for k in range(20)] + [(k, " \n ".join(prose(rng, 20)) + " ") for k in range(20, 30)]
    rows += [(100 + k, rows[k][1][: 300 + 10 * k] + " " + rows[k + 1][1]) for k in range(25)]
    for r in lz.parsed(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        words = dict(rows)[r.doc_id].split()
        gone = {k for s in r.spans or [] for k in range(s.begin, s.end)}
        assert len(gone) == r.n_removed and all(a.end < b.begin for a, b in zip(r.spans or [], (r.spans or [])[1:], strict=False))
        if r.spans:
            assert r.kept == " ".join(w for k, w in enumerate(words) if k not in gone)
        else:
            assert r.kept is None


def test_hot_passage_in_a_third_of_the_rows(spark):
    rng = random.Random(11)
    passage = " ".join(prose(rng, 60))
    rows = [(k, " ".join(prose(rng, 30)) + (" " + passage if k % 3 == 0 else "") + f" end{k}") for k in range(900)]
    got = lz.parsed(spark.createDataFrame(rows, "doc_id long, text string"), block_words=500, task_words=2000)
    assert result(got) == brute(rows)
    assert Counter(r[2] >= 60 for r in result(got))[True] == 299


def test_edge_cases(docs, none):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    clashing = docs.withColumnsRenamed({"lang": "digest", "source": "at", "n_chars": "spans"})
    assert result(lz.parsed(clashing)) == brute(rows)
    assert lz.parsed(none).count() == 0
    kept = {r.doc_id: r.kept for r in lz.parsed(docs).collect() if r.doc_id}
    assert kept[7] == "" and kept[6] is None
