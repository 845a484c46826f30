import random
from itertools import combinations

from pyspark.sql import functions as F

from llm_fixtures import docs, none  # noqa: F401
from orrery.llm import decontaminate as d


def vocabulary(n=4000, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


def setup():
    rng = random.Random(4)
    words = vocabulary()
    pick = lambda n: [rng.choice(words) for _ in range(n)]
    items = [pick(n) for n in (15, 22, 34, 55, 7, 3)]
    docs, leaks = [], {}
    for k in range(60):
        doc = pick(rng.choice([5, 60, 400]))
        if k % 3 == 0:
            i = (k // 3) % 5
            passage = list(items[i])
            if len(passage) >= 15:
                for at in range(4, len(passage), 9):
                    passage[at] = "substituted"
            at = rng.randrange(len(doc))
            doc = doc[:at] + passage + doc[at:]
            leaks[k] = i
        docs.append((k, ", ".join(doc).upper() if k % 2 else " ".join(doc)))
    return docs, [(i, " ".join(t)) for i, t in enumerate(items)] + [(9, " ".join(items[0])), (10, None), (11, "")], leaks


def brute(docs, tests):
    out = set()
    known = d._Hashes()
    first = {}
    for i, t in tests:
        toks = d.tokens_of(t, known)
        if len(toks) >= d.MIN_TOKENS:
            first.setdefault(toks.tobytes(), (i, toks))
    for k, text in docs:
        toks = d.tokens_of(text, known)
        for i, item in first.values():
            n = min(d.WINDOW, len(item))
            best = max((int((toks[a : a + n] == item[b : b + n]).sum()) for a in range(len(toks) - n + 1) for b in range(len(item) - n + 1)), default=0)
            if best >= d.SHARE * n:
                out.add((k, i))
    return out


def test_agrees_with_all_alignments(spark):
    docs, tests, leaks = setup()
    df, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.overlaps(df, items).collect()}
    assert got == brute(docs, tests) == {(k, i) for k, i in leaks.items()}
    kept = {r.doc_id for r in d.drop_contaminated(df, items).collect()}
    assert kept == {k for k, _ in docs} - set(leaks)


def test_substitutions_up_to_the_share_are_tolerated(spark):
    words = vocabulary()
    item = words[:30]
    rows = []
    for k, every in enumerate((0, 6, 5, 3, 2)):
        rows.append((k, " ".join(["x"] * 40 + [w if not every or (j % every) else "zz" for j, w in enumerate(item)] + ["y"] * 40)))
    df, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in d.overlaps(df, items).collect()} == {0, 1, 2}


def test_edge_cases(docs, none, spark):
    items = spark.createDataFrame([(None, "three four five six seven"), (2, None), (3, "two three")], "item_id long, text string")
    got = d.overlaps(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.equal, r.compared, r.at) for r in got] == [(5, None, 5, 5, 2)]
    wide = docs.withColumn("doc_", F.lit(1)).withColumn("hash_", F.lit(2)).withColumn("item_id", F.lit(3))
    kept = d.drop_contaminated(wide, items)
    assert kept.columns == wide.columns and kept.count() == docs.count() - 2
    assert d.overlaps(none, items).count() == 0 and d.overlaps(docs, items.where("false")).count() == 0


def test_a_filter_that_is_too_small_costs_time_and_no_hits(spark, monkeypatch):
    docs, tests, leaks = setup()
    monkeypatch.setattr(d, "FILTER_BITS", 6)
    df, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string")
    assert {r.doc_id for r in d.overlaps(df, items).collect()} == set(leaks)


def test_short_items_with_substitutions(spark):
    words = vocabulary()
    sizes = range(5, 16)
    tests = [(n, " ".join(words[100 * n : 100 * n + n])) for n in sizes]
    rng, docs = random.Random(6), []
    for n in sizes:
        for allowed in ([(k,) for k in range(n)] + [sorted(rng.sample(range(n), n - -(-4 * n // 5))) for _ in range(8)] + ([(2, 5, 9), (4, 7, 11)] if n == 15 else [])):
            passage = ["zz" if i in allowed else w for i, w in enumerate(words[100 * n : 100 * n + n])]
            docs.append((len(docs), " ".join(["x"] * 20 + passage + ["y"] * 20)))
    df, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.overlaps(df, items).collect()}
    want = brute(docs, tests)
    assert got == want and len(want) == len(docs)


def test_seeds_cover_all_substitutions_of_a_window():
    fits = lambda gone, m: any(all(c == "0" or a + i not in gone for i, c in enumerate(m)) for a in range(16 - len(m)))
    assert all(any(fits(gone, m) for m in d.MASKS) for gone in combinations(range(15), 3))
