"""The stages of the pipeline against brute force."""

import collections
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from cellgrid.llm import common, jaccard


def _grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_dedup_stage(spark):
    rng = random.Random(3)
    footer = " ".join(f"legal{k}" for k in range(70))
    texts = [None, "", " \n", "one two", "ONE two", "one two three"]
    for k in range(24):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([60, 90, 150]))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(1, 5)):
            copy = list(words)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(9999)}"
            texts.append(" ".join(copy) + (f" {footer}" if k % 6 == 0 else ""))
            words = copy if k % 3 == 0 else words  # chains, and stars
    texts += [f"{footer} a{k} b{k} c{k}" for k in range(30)] + [texts[6].upper()]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)] + [(None, texts[6], "en", "s", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    grams = {i: _grams(t) for i, t, *_ in rows if i is not None}
    root = {i: i for i in grams}
    for i in grams:
        for j in grams:
            x, y = grams[i], grams[j]
            if i < j and root[i] != root[j] and (x == y or (x and y and len(x & y) / len(x | y) >= 0.8)):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == corpus_pipeline.COLUMNS
    got = [r.doc_id for r in got.collect()]
    assert sorted(got) == sorted(set(root.values()))  # rows without an id are copies like others
    twice = docs.unionAll(docs).unionAll(spark.sql("SELECT doc_id, concat(text, ' and quite another text for the same id') AS text, lang, source, n_chars FROM VALUES (0L, 'x', 'en', 's', 1L) t(doc_id, text, lang, source, n_chars)"))
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, twice, "").collect()) == sorted([*set(root.values()), 0])
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0


def test_jaccard_limit():
    x, y = set(range(8)), set(range(10))
    assert jaccard.near(x, y) and not jaccard.near(x - {0}, y) and jaccard.near(set(), set())


def test_parity_sketches_never_differ_in_more_than_the_sets_do():
    rng = np.random.default_rng(5)
    for n in (0, 1, 3, 100, 300, 3000, 40_000):
        for gone in (0, n // 100, n // 9, n // 2):
            s = rng.integers(0, 2**64, n + gone, np.uint64, endpoint=False)
            x, y = (jaccard._parity(z, bits).tobytes() for z, bits in ((s[:n], 4096), (s[gone:], 512 if n < 300 else 65_536)))
            assert jaccard._differ(x, y) <= 2 * gone and jaccard._differ(x, x) == 0


def test_near_dedup_of_a_large_group_of_near_copies(spark, monkeypatch):
    """Copies that are less near than 0.8 to each other: their pairs are not all compared by text, and no link is lost."""
    rng = random.Random(7)
    base, texts = [f"w{k}" for k in range(300)], []
    for k in range(160):
        words = list(base)
        for at in rng.sample(range(300), rng.choice([2, 5, 8, 9, 10])):
            words[at] = f"own{k}x{at}"
        texts.append(" ".join(words))
    counted, verified = [], jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *more: counted.append(pairs.count()) or verified(pairs, *more))
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    root = _components({k: _grams(t) for k, t in enumerate(texts)})
    assert got == sorted(set(root.values())) and 20 < len(got) < 140
    assert sum(counted) < 10 * len(texts)


def _components(grams):
    root = {i: i for i in grams}
    for i in grams:
        for j in grams:
            x, y = grams[i], grams[j]
            if i < j and root[i] != root[j] and (x == y or (x and y and len(x & y) / len(x | y) >= 0.8)):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    return root


def test_stages_one_by_one(spark, tmp_path):
    public = pytest.importorskip("public_tokenizers")
    import sentencepiece as library

    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*corpus_pipeline.COLUMNS)
    odd = spark.createDataFrame([(None, None, "en", "s", None), (None, "", None, None, 0), (5, "short text", "en", "s", 10), (10**6, " ".join(dict.fromkeys(a + b + "on" for a in "bdfglmnprst" for b in ("a", "e", "i", "o", "u", "ea", "ou"))) + ". Mail a.b@c-d.org or +1 (017) 555-7713 now.", "en", "s", 5)], source.schema)
    docs = source.unionByName(odd).unionByName(source.limit(3))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    made = len(common.MADE)
    at, outs = docs, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(str(tmp_path / f"s{k}"))
        at = spark.read.parquet(str(tmp_path / f"s{k}"))
        outs.append(at.collect())
        assert k == 4 or at.columns == corpus_pipeline.COLUMNS
        # An empty table stays empty.
        assert k in (1, 3) or stage(spark, at.limit(0) if k < 4 else outs_df.limit(0), str(tmp_path)).count() == 0
        outs_df = at
    first, second, third, fourth, fifth = outs

    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", t or "")

    def failed(t):
        w = words(t)
        grams = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {p for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        return len(w) < 50 or 100 * len(again) > 50 * len(w)

    before = collections.Counter((r.doc_id, r.text) for r in docs.collect())
    after = collections.Counter((r.doc_id, r.text) for r in first)
    assert not after - before and not any(failed(t) for _, t in after) and len(first) > 0.5 * sum(n for (_, t), n in before.items() if not failed(t))
    root = _components({k: _grams(r.text) for k, r in enumerate(first)})
    groups = collections.defaultdict(list)
    for k, r in enumerate(first):
        groups[root[k]].append(r)
    assert len(second) == len(groups)
    assert sorted(r.doc_id for r in second) == sorted(min(x.doc_id for x in g) for g in groups.values())
    texts = {r.doc_id: r.text for r in second}
    assert sorted(r.doc_id for r in third) == sorted(texts)
    for r in third:
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r.text) and r.n_chars == len(r.text)
        if not re.search(r"[0-9@]", texts[r.doc_id]):
            assert r.text == texts[r.doc_id]
    assert any("<EMAIL> or <PHONE>" in r.text for r in third)
    assert {r.doc_id for r in fourth} <= {r.doc_id for r in third} and len(fourth) > 0.8 * len(third)
    lib = library.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    text = {r.doc_id: r.text for r in fourth}
    assert all(r.ids == lib.encode(text[r.doc_id]) and r.n_tokens == len(r.ids) for r in fifth) and len(fifth) == len(fourth)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r.doc_id, r.ids) for r in whole.collect()) == sorted((r.doc_id, r.ids) for r in fifth)
    assert len(common.MADE) > made
