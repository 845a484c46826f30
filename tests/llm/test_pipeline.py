import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import docs, none  # noqa: F401
from test_jaccard import brute_survivors
import corpus_pipeline
from orrery.llm import decontaminate, quality, secrets, simhash
from orrery.llm.common import table

SF = "/root/testdata/sf0.001"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_quality(docs):
    """Rules from first principles: the base rule, and the fences of each language and source."""
    from test_quality import brute_fences
    import re
    from collections import Counter

    kept, rows = {}, []
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        n = Counter(grams)
        repeats = len({i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)})
        if len(words) >= 50 and 2 * repeats <= len(words):
            lines = [x for x in d.text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
            chars = sum(map(len, words))
            rows.append((d, {
                "symbol_share": sum(d.text.count(c) for c in "#*$%&|<>") * 10000 // chars, "dup_line_share": (len(lines) - len(set(lines))) * 10000 // len(lines),
                "repeat_share": repeats * 10000 // len(words), "word_length": chars * 100 // len(words),
            }))

    fences = brute_fences([(d.lang, d.source, m) for d, m in rows])
    for d, m in rows:
        limits = fences[d.lang, d.source]
        if all(m[k] <= limits[k][1] and (side == "high" or m[k] >= limits[k][0]) for k, (side, _, _) in quality.MEASURES.items()):
            kept[d.doc_id] = d.text
    return kept


def brute_contaminated(text, items):
    known = decontaminate._Hashes()
    doc = decontaminate.tokens_of(text, known)
    for item in items:
        toks = decontaminate.tokens_of(item, known)
        n = min(decontaminate.WINDOW, len(toks))
        if n < decontaminate.MIN_TOKENS or len(doc) < n:
            continue
        same = doc[:, None] == toks[None, :]
        windows = sum(same[k : len(doc) - n + k + 1, k : len(toks) - n + k + 1].astype(np.int8) for k in range(n))
        if windows.max() >= decontaminate.SHARE * n:
            return True
    return False


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settled(stage(spark, docs, SF))
        out.append((name, docs))
    return dict(out)


def test_stages_agree_with_brute_force(spark, steps):
    docs = table(spark, SF, "documents").collect()
    want = brute_quality(docs)
    got = {name: {r.doc_id: r for r in df.collect()} for name, df in steps.items()}
    texts = lambda name: {i: r.text for i, r in got[name].items()}
    assert texts("quality_rules") == want and 0 < len(want) < len(docs)
    survivors = brute_survivors(want)  # similarity 0.8 of five-word shingles
    want = {i: t for i, t in want.items() if i in survivors}
    assert texts("near_duplicates") == want
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    want = {i: t for i, t in want.items() if not brute_contaminated(t, items)}
    assert texts("benchmark_passages") == want and len(want) < len(got["near_duplicates"])
    assert set(got["secret_spans"]) == set(want)
    rest = secrets.scanned(steps["secret_spans"])
    assert rest.where("size(base) > 0").isEmpty()
    assert all(t == want[i] or "[SECRET]" in t for i, t in texts("secret_spans").items())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, t in texts("secret_spans").items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(got["token_ids"][i].ids, "<u4").tolist() == ids
        assert got["token_ids"][i].decoded == library.decode(ids, skip_special_tokens=False)


def test_all_but_the_last_stage_return_documents(steps):
    assert [name for name, df in steps.items() if df.columns != DOCUMENTS] == ["token_ids"]
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_passages", "secret_spans", "token_ids"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_every_stage_takes_edge_cases(spark, docs, none):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
        assert stage(spark, docs, SF).count() <= docs.count()
    assert simhash.drop_near_duplicates(docs).columns == DOCUMENTS
