import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_fixtures import docs, none  # noqa: F401
from orrery.llm import jaccard
from orrery.llm.common import table


def brute_survivors(texts):
    """Smallest id of each group, by the similarity of every pair that shares a shingle."""
    sets, having = {}, {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
        for s in sets[i]:
            having.setdefault(s, []).append(i)
    label = {i: i for i in texts}
    near = []
    for i, own in sets.items():
        shared = Counter(j for s in own for j in having[s] if j < i)
        near += [(i, j) for j, n in shared.items() if n / (len(own) + len(sets[j]) - n) >= 0.8]
    changed = True
    while changed:
        changed = False
        for i, j in near:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return set(label.values())


def wordy(rng, n):
    return [f"word{rng.randrange(5000)}" for _ in range(n)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_stage_agrees_with_brute_force_on_documents(spark, sf):
    raw = table(spark, f"/root/testdata/{sf}", "documents")
    texts = {r.doc_id: r.text for r in raw.collect() if (r.text or "").split()}
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, raw.where(F.col("doc_id").isin(list(texts))), "").collect()}
    assert got == brute_survivors(texts)


def test_texts_on_both_sides_of_the_limit(spark):
    rng = random.Random(2)
    rows = []
    for k in range(40):
        base = wordy(rng, 104)  # 100 shingles; a changed end word takes one, an inner one five
        rows.append((10 * k, " ".join(base)))
        rows.append((10 * k + 1, " ".join(base[:50] + ["x"] + base[51:75] + ["y"] + base[76:])))  # 90 of 110
        rows.append((10 * k + 2, " ".join(base[:20] + wordy(rng, 84))))  # few
    texts = dict(rows)
    got = {r.doc_id for r in jaccard.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_survivors(texts) == {10 * k + j for k in range(40) for j in (0, 2)}


def test_a_chain_is_one_group(spark):
    rng = random.Random(4)
    line = wordy(rng, 800)
    texts = {k: " ".join(line[20 * k : 20 * k + 300]) for k in range(25)}  # neighbours 0.87, ends 0
    got = {r.doc_id for r in jaccard.drop_near_copies(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == brute_survivors(texts) == {0}


def test_tries_give_the_first_candidates(spark):
    rng = random.Random(6)
    rows = []
    for k in range(30):
        base = wordy(rng, 400)
        rows += [(4 * k + j, " ".join(base[: 400 - j])) for j in range(3)]  # a few end words gone
        rows.append((4 * k + 3, " ".join(base[:390] + wordy(rng, 10))))
    marked = jaccard._signed(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    fps = {r.text_hash: r.fp for r in marked.collect()}
    near = [(a, b) for a in fps for b in fps if a < b and ((fps[a] ^ fps[b]) & (2**64 - 1)).bit_count() <= 3]

    def groups(pairs):
        label = {i: i for i in fps}
        for _ in fps:
            for u, v in pairs:
                label[u] = label[v] = min(label[u], label[v])
        return label

    assert len(near) > 60 and groups(jaccard.walked(marked).collect()) == groups(near)


def test_edge_cases(docs, none):
    kept = jaccard.drop_near_copies(docs.withColumn("node", F.lit(1)).withColumn("keys", F.lit("x")))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 4, 5, 6, 8]
    assert kept.columns == [*docs.columns, "node", "keys"]
    assert jaccard.drop_near_copies(none).count() == 0
