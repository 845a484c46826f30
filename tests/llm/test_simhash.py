import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import docs, none  # noqa: F401
from orrery.llm import simhash
from orrery.llm.components import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    found = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    votes = [sum(xxhash.xxh64_intdigest(s, 42) >> j & 1 for s in found) for j in range(64)]
    return sum(1 << j for j in range(64) if 2 * votes[j] > len(found))


def brute_components(values, budget=3):
    label = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= budget and label[a] > label[b]:
                    label[a], changed = label[b], True
    return label


def signed(v):
    return v - (1 << 64) if v >= 1 << 63 else v


def test_fingerprints_and_components_of_edge_cases(docs):
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id}
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    assert {r.doc_id: r.fp & (2**64 - 1) for r in found if r.doc_id} == {k: brute_fingerprint(t) for k, t in texts.items()}
    by_id = {r.doc_id: r.component_id for r in found if r.doc_id}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[6] == by_id[7] == 6 and by_id[5] == 5
    assert {r.component_id for r in found if r.doc_id is None} == {1, None}


def test_only_ascii_is_lower_cased(spark):
    df = spark.createDataFrame([(1, "A B Ä"), (2, "a b Ä"), (3, "a b ä")], "doc_id long, text string")
    fp = {r.doc_id: r.fp for r in simhash.fingerprints(df).collect()}
    assert fp[1] == fp[2] != fp[3]


def test_empty(none):
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0


@pytest.mark.parametrize("per_trie", [4, 200_000])
def test_links_join_what_brute_force_joins(spark, per_trie):
    rng = random.Random(5)
    values = {0, 1, 2**64 - 1}
    for _ in range(40):
        v = rng.getrandbits(64)
        for _ in range(4):
            values.add(v)
            for _ in range(rng.choice([1, 2, 3, 4])):
                v ^= 1 << rng.randrange(64)
    head = rng.getrandbits(16) << 48
    values |= {head | rng.getrandbits(10) for _ in range(60)}  # one crowded block
    want = brute_components(values)
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = {r.node: r.root for r in components(simhash.links(fps, 3, per_trie)).collect()}
    groups = {}
    for v in values:
        groups.setdefault(got.get(signed(v), signed(v)), set()).add(want[v])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(want.values()))


def test_a_dense_ball_is_one_component():
    center = 0x0123456789ABCDEF
    vals = np.array(sorted({center} | {center ^ (1 << a) for a in range(48)}), np.uint64)
    one = np.array([0])
    label = simhash.join_tries(vals, (one, one + len(vals), one, one + len(vals), one, np.array([True])), 63, 3)
    assert (label == 0).all()


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[k] == 100 for k in range(100, 140))
    assert got[301] == got[300] == 300 and 200 not in got


def test_one_of_each_group_stays_with_its_columns(docs):
    df = docs.withColumn("id", F.lit("x")).withColumn("text_hash", F.lit(1)).withColumn("at_", F.lit(2))
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id) == [1, 4, 5, 6, 8]
    assert [r.text for r in rows if r.doc_id is None] == ["a text without an id"]


def test_near_copies_meet_and_others_do_not(spark):
    rng = random.Random(1)
    vocabulary = [f"word{i}" for i in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(900)]
    near = base[:450] + ["changed"] + base[451:]
    other = [rng.choice(vocabulary) for _ in range(900)]
    df = spark.createDataFrame([(3, " ".join(base)), (2, " ".join(near)), (1, " ".join(other))], "doc_id long, text string")
    fp = {r.doc_id: r.fp & (2**64 - 1) for r in simhash.fingerprints(df).collect()}
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    assert (got[3] == 2) == ((fp[3] ^ fp[2]).bit_count() <= 3) and got[1] == 1
