"""The pipeline: every stage on what the one before it kept, held against brute force."""

from __future__ import annotations

import collections
import hashlib

import numpy as np
import pytest
from test_text_operators import WORDS, brute_lines, classes, prose, shingle_set

import corpus_pipeline
from pitchflow.llm import mixing, tokens


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(12)
    texts = [prose(rng, int(rng.integers(60, 250))) for _ in range(60)]
    texts += [texts[i] for i in (3, 3, 9)] + [texts[i] + " More." for i in (4, 5)]
    for i in range(10, 30, 2):
        texts[i] += "\nThis very line is repeated in a number of documents."
    texts += [" | ".join(rng.choice(WORDS, 80)) for _ in range(30)]
    rows = [(i, t, "en", f"src{i % 3}", len(t), "kept") for i, t in enumerate(texts)] + [(200, None, None, None, None, None)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 65)) for i in range(0, 95, 2)], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
        out.append(docs)
    return out


def rows(df) -> list[tuple]:
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_bad_documents_go(stages):
    kept = {i for i, t, _ in rows(stages[1]) if t}
    assert kept <= set(range(95)) and len(kept & set(range(65))) >= 64 and len(kept - set(range(65))) <= 1


def test_lines_go(stages):
    want = collections.Counter((i, t) for i, t, *_ in brute_lines(rows(stages[1]), 5))
    assert collections.Counter((i, t or "") for i, t, _ in rows(stages[2])) == want
    assert all(r.n_chars == len(r.text) for r in stages[2].collect() if r.text is not None)


def test_one_of_each_class_stays(stages):
    before = [(i, t) for i, t, _ in rows(stages[2])]
    part, _ = classes([shingle_set(t or "") for _, t in before])
    least: dict = {}
    for (i, t), p in zip(before, part, strict=True):
        key = p if shingle_set(t or "") else t or ""
        least[key] = min(least.get(key, i), i)
    assert sorted(i for i, *_ in rows(stages[3])) == sorted(least.values())
    assert len(before) - len(least) >= 5


def test_mixture_takes_what_was_drawn(stages):
    mixed = mixing.mix(stages[3].select("doc_id", "source", "text"))
    want = collections.Counter({r.doc_id: len(r.draws) for r in mixed.collect() if r.draws})
    assert collections.Counter(i for i, *_ in rows(stages[4])) == want and sum(want.values()) > 20


def test_ids_are_the_library_s(stages):
    library = tokens.Encoder(tokens.default_path()).library
    texts = {i: t for i, t, _ in rows(stages[4])}
    for r in stages[5].collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_is_the_stages_in_turn(spark, folder, stages):
    digests = lambda df: collections.Counter((r.doc_id, r.ids_sha256) for r in df.collect())
    assert digests(corpus_pipeline.run(spark, folder)) == digests(stages[5])


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0
