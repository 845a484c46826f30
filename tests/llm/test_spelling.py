import random
from collections import Counter
from zlib import crc32

import duckdb
import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs, none  # noqa: F401
from orrery.llm import spelling
from orrery.llm.common import table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def brute_counts(rows):
    """Runs letter by letter, checksums of whole strings."""
    n = Counter()
    for i, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c in UPPER or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c in UPPER else c
                continue
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if run and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                n[run] += 1
            run = ""
    return n


def is_near(a, b):
    """Exactly one inserted, deleted or replaced letter, by the equal beginning and ending."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    skip = len(a) == len(b)
    if len(a) < len(b):
        a, b = b, a
    return a[head + 1 :] == b[head + skip :]


def brute_variants(n, times=2):
    by_part = {}
    for w in n:  # words at one edit share a half
        for key in {w[: len(w) // 2 - 1], w[: (len(w) + 1) // 2 - 1], w[: (len(w) - 1) // 2 - 1]}:
            by_part.setdefault(("head", key), set()).add(w)
        for key in {w[(len(w) - k) // 2 + k :] for k in (-1, 0, 1, 2)}:
            by_part.setdefault(("tail", key), set()).add(w)
    near = {w: set() for w in n}
    for group in by_part.values():
        for a in group:
            near[a] |= {b for b in group if is_near(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_agrees_with_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    n = brute_counts([(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()])
    want = brute_variants({w: k for w, k in n.items() if k >= 3})
    assert result(spelling.op11(spark, folder)) == want
    assert any(r[3] for r in want)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql_agrees_with_brute_force(sf):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS FROM '/root/testdata/{sf}/documents.parquet'")
    n = brute_counts(duckdb.sql("SELECT doc_id, text FROM documents").fetchall())
    assert sorted(duckdb.sql(spelling.OP11_SQL).fetchall()) == brute_variants({w: k for w, k in n.items() if k >= 3})


def all_pairs(n, times=2):
    """As ``brute_variants``, but every pair of words is compared."""
    return [(w, sum(is_near(w, x) for x in n)) for w in sorted(n)]


def test_every_pair_of_short_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "WORDS_PER_BUCKET", 50)
    monkeypatch.setattr(spelling, "LETTERS_AT_ONCE", 40)
    rng = random.Random(8)
    words = {"".join(rng.choice("aab🙂ü") for _ in range(rng.randrange(1, 9))): rng.randrange(1, 40) for _ in range(700)}
    words |= {"a" * k: k for k in range(1, 30)} | {"x" * 3000: 5, "x" * 2999 + "y": 50, "x" * 2999: 200}
    got = result(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)))
    assert [(r[0], r[2]) for r in got] == all_pairs(words)
    near = {w: [x for x in words if is_near(w, x)] for w in words}
    for w, n, _, form, form_n, root in got:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        holds = best is not None and words[best] >= 2 * n
        assert (form, form_n) == ((best, words[best]) if holds else (None, None))
        assert form is not None or root == w
    roots = {r[0]: r for r in got}
    for w in words:
        end = w
        while roots[end][3]:
            end = roots[end][3]
        assert roots[w][5] == end
    assert roots["x" * 3000][5] == "x" * 2999


def test_one_letter_with_many_values_is_no_list_of_pairs(spark):
    """A third of the words share a skipping pair: each row meets a count, not its partners."""
    words = [(f"abcd{chr(0x4E00 + k)}", k + 1) for k in range(3000)] + [(f"w{k}ord", 1) for k in range(6000)]
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    top = words[2999][0]
    assert all(got[w].n_near == 2999 for w, _ in words[:3000])
    assert got[top].form is None and got[words[0][0]].form == got[words[0][0]].root == top


def test_counts_of_many_batches(spark, monkeypatch):
    monkeypatch.setattr(spelling, "WORDS_HELD", 10)
    rows = [(k, f"Mädchen ÄRGER the colour Colour, color: x{k} " + "words " * (k % 4)) for k in range(300)]
    got = {r.word: r.n for r in spelling.word_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute_counts(rows)


def test_edge_cases(spark, docs, none):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    clashing = docs.withColumnsRenamed({"lang": "word", "source": "n", "n_chars": "place"})
    n = brute_counts(rows)
    assert {r.word: r.n for r in spelling.word_counts(clashing).collect()} == n
    assert result(spelling.variants(spelling.word_counts(docs))) == brute_variants(n)
    assert spelling.variants(spelling.word_counts(none)).count() == 0
    odd = spark.createDataFrame([(None, 3, 1), ("", 4, 1), ("tie", None, 1), ("tie", 2, 1), ("ties", 4, 1), ("tied", 4, 1)], "word string, n long, place int")
    assert result(spelling.variants(odd)) == [("tie", 2, 2, "tied", 4, "tied"), ("tied", 4, 2, None, None, "tied"), ("ties", 4, 2, None, None, "ties")]
    assert spelling.variants(odd.where(F.lit(False))).columns == ["word", "n", "n_near", "form", "form_n", "root"]
