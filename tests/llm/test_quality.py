import re
from collections import Counter
from fractions import Fraction

from pyspark.sql import functions as F

from llm_fixtures import docs, none  # noqa: F401
from orrery.llm import quality
from orrery.llm.common import settled

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_counts_agree_with_a_loop(docs, spark):
    more = spark.createDataFrame([(20, "a b c a b c x\na b c\na b c\n \n \n"), (21, "#%% a&b | <x>\r\nq\x0bw\x0ce"), (22, "x x x x"), (23, "a b c\x1cd"), (24, "p q p q p q r")], "doc_id long, text string")
    df = docs.select("doc_id", "text").unionByName(more)
    for r in quality.measured(df).collect():
        m = r.measures
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == brute(r.text), r.doc_id


def test_buckets_are_a_monotone_sketch(spark):
    df = spark.range(0, 300_000, 7).select("id", quality.bucket(F.col("id")).alias("b")).withColumn("low", quality.lower_end(F.col("b")))
    bad = df.where((F.col("low") > F.col("id")) | (F.col("id") > F.col("low") * 1.04)).count()
    assert bad == 0
    assert df.groupBy().agg(F.count_if(F.col("id") < 64).alias("x"), F.sum(F.when(F.col("id") < 64, F.col("b") - F.col("id")))).first()[1] == 0


def corpus(spark, junk=1):
    words = lambda i: " ".join(f"word{(i * 37 + k * k) % 1009}" for k in range(80 + i % 40))
    rows = [(i, words(i), "en", f"s{i % 2}") for i in range(400)]
    rows += [(1000 + i, words(i).replace(" ", "### "), "en", "s0") for i in range(junk)]
    rows += [(2000, "too short", "en", "s0"), (2001, None, "en", "s0"), (2002, "same three words " * 50, "en", "s1"), (2003, words(5), None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_outliers_go_and_the_rest_stays(spark):
    found = {r.doc_id: r.verdict for r in quality.judged(corpus(spark, 3)).collect()}
    assert [i for i in range(400) if not found[i].kept] == []
    assert all(found[1000 + i].failed == ["symbol_share", "word_length"] or "symbol_share" in found[1000 + i].failed for i in range(3))
    assert found[2000].base_failed and found[2001].base_failed and found[2002].base_failed
    assert found[2003].kept  # alone in its language: nothing to be beyond


def test_fences_follow_the_stratum(spark):
    """One value, two verdicts: symbols are common in code and unheard of in prose."""
    plain = [(i, " ".join(f"w{(i + k * 13) % 501}" for k in range(90)), "en", "prose") for i in range(400)]
    code = [(500 + i, " ".join(f"w{(i + k * 13) % 501}<{'&' * (k % 2)}" for k in range(90)), "en", "code") for i in range(400)]
    odd = [(1000, code[0][1], "en", "prose")]
    df = spark.createDataFrame(plain + code + odd, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r.verdict for r in quality.judged(df).collect()}
    assert all(found[r[0]].kept for r in plain + code)
    assert "symbol_share" in found[1000].failed and found[500].kept


def brute_fences(rows):
    """(lang, source) to measure to (low, high) of (lang, source, measures): quantiles of expanded lists, in fractions."""

    def ends(x):
        shift = max(0, x.bit_length() - 6)
        return x >> shift << shift, ((x >> shift) + 1 << shift) - 1

    out = {}
    for lang, source in {r[:2] for r in rows}:
        for m, (_, level, reach) in quality.MEASURES.items():
            mass = Counter()
            of_lang = [ends(r[2][m]) for r in rows if r[0] == lang]
            for x in of_lang:
                mass[x] += Fraction(quality.PRIOR, len(of_lang))
            for r in rows:
                mass[ends(r[2][m])] += r[:2] == (lang, source)
            total, upto, at = sum(mass.values()), 0, {}
            for x in sorted(mass):
                upto += mass[x]
                for p in (50, level, 100 - level):
                    if 100 * upto >= p * total:
                        at.setdefault(p, x)
            (below, above), top, bottom = at[50], at[level][1], at[100 - level][0]
            out.setdefault((lang, source), {})[m] = bottom - (above - bottom) * reach, top + (top - below) * reach
    return out


def test_fences_agree_with_a_loop_and_come_from_the_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang", "source")
    found = settled(quality.measured(docs).drop("text"))
    limits = {(r["lang"], r["source"]): r.fence for r in quality.limits_of(found, "measures", "lang", "source").collect()}
    rows = [(r["lang"], r["source"], r.measures) for r in found.where(~quality.base_failed(F.col("measures"))).collect()]
    want = brute_fences(rows)
    assert limits.keys() == want.keys()
    for key, fence in limits.items():
        assert {m: (fence[f"{m}_low"], fence[f"{m}_high"]) for m in quality.MEASURES} == want[key], key
    # Strata differ, and the fences of three measures lie where the data are, not at a constant.
    assert all(len({f[m][1] for f in want.values()}) > 3 for m in ("dup_line_share", "repeat_share", "word_length"))


def test_every_fence_of_a_share_decides_somewhere(spark):
    found = quality.op2(spark, "/root/testdata/sf0.1").where("NOT base_failed AND NOT kept")
    failed = {m for r in found.select("failed").distinct().collect() for m in r.failed.split(",")}
    assert failed >= {"symbol_share", "repeat_share", "word_length"}


def test_own_columns_survive_and_empty_tables_pass(docs, none, spark):
    df = corpus(spark).withColumn("measures", F.lit(1)).withColumn("verdict", F.lit("v")).withColumn("fence", F.lit(2))
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.where("measures <> 1 or verdict <> 'v' or fence <> 2").count() == 0
    assert quality.keep_good(none).count() == 0
    assert quality.judged(docs).count() == docs.count()
