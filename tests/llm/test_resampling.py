import math
import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest

from llm_fixtures import docs, none  # noqa: F401
from orrery.llm import resampling
from orrery.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, width=2):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[k : k + n]) for n in range(1, width + 1) for k in range(len(words) - n + 1)]


def brute(rows, target, width=2, buckets=10_000, percent=25, min_words=20, seed=7):
    """Every n-gram as a string, one CRC for each."""
    bucket = lambda f: crc32(f.encode()) % buckets
    own = [(i, *features(t, width)) for i, t in rows]
    s = Counter(bucket(f) for _, _, fs in own for f in fs)
    t = Counter(bucket(f) for text in target for f in features(text, width)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for i, n, fs in own:
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        out.append([i, len(fs), weight, weight + resampling.noise(i, seed), None, n])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_crc_of_every_run_follows_from_running_values():
    rng = random.Random(3)
    texts = [[("é" * rng.randrange(3) + "x" * rng.choice([1, 2, 5, 60, 70, 5000])).encode() for _ in range(rng.randrange(9))] for _ in range(40)]
    words = [w for t in texts for w in t]
    crcs, owner = resampling.run_crcs(words, [len(t) for t in texts], 3, resampling.Shifts())
    want = Counter((k, crc32(b" ".join(t[a : a + n]))) for k, t in enumerate(texts) for n in (1, 2, 3) for a in range(len(t) - n + 1))
    assert Counter(zip(owner.tolist(), crcs.tolist(), strict=True)) == want
    assert len(resampling.run_crcs([], [0, 0], 2, resampling.Shifts())[0]) == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_agrees_with_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    want = brute(rows, [r.text for r in table(spark, folder, "benchmark").collect()])
    assert result(resampling.op13(spark, folder)) == want


def test_sql_agrees(spark):
    folder = "/root/testdata/sf0.001"
    for name in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS FROM '{folder}/{name}.parquet'")
    assert sorted(duckdb.sql(resampling.OP13_SQL).fetchall(), key=str) == result(resampling.op13(spark, folder))


def test_other_parameters(spark, monkeypatch):
    monkeypatch.setattr(resampling, "SCAN_BYTES", 100)
    monkeypatch.setattr(resampling, "ROWS_PER_BUCKET", 7)
    rng = random.Random(5)
    rows = [(k, " ".join(f"w{rng.randrange(60)}" for _ in range(k % 40))) for k in range(200)]
    target = [" ".join(f"w{rng.randrange(9)}" for _ in range(30))]
    options = dict(percent=60, width=3, buckets=70_000, min_words=5, seed=9)
    got = resampling.resampled(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame([(t,) for t in target], "text string"), **options)
    assert result(got) == brute(rows, target, **{k: v for k, v in options.items()})


def test_target_like_documents_are_drawn(spark):
    rng = random.Random(6)
    like = [(k, " ".join(f"a{rng.randrange(50)}" for _ in range(200))) for k in range(100)]
    other = [(k, " ".join(f"b{rng.randrange(50)}" for _ in range(200))) for k in range(100, 400)]
    target = spark.createDataFrame([(" ".join(f"a{rng.randrange(50)}" for _ in range(200)),) for _ in range(100)], "text string")
    got = resampling.resampled(spark.createDataFrame(like + other, "doc_id long, text string"), target)
    drawn = sorted(r.doc_id for r in got.collect() if r["rank"])
    assert len(drawn) == 100 and np.mean([d < 100 for d in drawn]) > 0.9


def test_edge_cases(spark, docs, none):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = docs.select("text")
    clashing = docs.withColumnsRenamed({"lang": "rank", "source": "id", "n_chars": "buckets"})
    for share in (0, 25, 100):
        got = result(resampling.resampled(clashing, target, percent=share, min_words=0))
        want = brute(rows, [t for _, t in rows], percent=share, min_words=0)
        assert [r[:4] for r in got] == [r[:4] for r in want]
        assert sorted(r[4] for r in got if r[4]) == sorted(r[4] for r in want if r[4])
    assert resampling.resampled(none, none).count() == 0
    empty = resampling.resampled(docs, none).collect()
    assert len(empty) == len(rows) and {r["rank"] for r in empty if not r.n_features} == {None}
