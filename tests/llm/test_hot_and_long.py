"""Hot keys, very long texts, bounded samples, and plain versions of the license and ownership rules."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderdesk.llm import covertree, learn, licences, piece, queries, secrets
from orderdesk.llm.common import fresh_keys

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


@pytest.fixture(scope="module")
def model():
    return piece.PieceModel(piece.model_bytes(queries.tokenizer_path(queries.PIECE_MODEL)))


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECE_MODEL))


@pytest.mark.parametrize("alphabet", [list("abest"), ["a"], ["con", "st", "const", "in", "arg", "et"], list(LETTERS), list("中é😀the_▁=0-")])
def test_rounds_of_long_words_equal_the_library(model, library, monkeypatch, alphabet):
    monkeypatch.setattr(piece, "LONG_WORD", 0)
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 8, 60, 500, 3000):
        for _ in range(4):
            text = "".join(rng.choice(alphabet, n))
            made = b"".join(model.encode_words(model.words(text)))
            assert np.frombuffer(made, dtype="<i4").tolist() == library.encode(text)


def test_a_text_of_megabytes_without_blanks(spark, library):
    text = "".join(np.random.default_rng(3).choice(list(LETTERS), 2_000_000))
    docs = spark.createDataFrame([(1, text), (2, "a short one"), (3, None), (4, text + " end")], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in piece.encode(docs, queries.tokenizer_path(queries.PIECE_MODEL)).collect()}
    assert got == {1: library.encode(text), 2: library.encode("a short one"), 3: [], 4: library.encode(text + " end")}


def test_computed_keys_let_a_hot_key_be_split(spark):
    names = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 40000, 1, 8).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("gram"), F.col("id").alias("x"))
        twice = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("gram")
        kept = rows.join(fresh_keys(twice, "gram").hint("merge"), "gram", "left_semi")
        got = kept.collect()
        assert len(got) == 26666 and {r.gram for r in got} == {7}  # multiples of three stand alone
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_sample_takes_one_text_of_a_doc_id(spark):
    docs = spark.createDataFrame([(1, f"text {i % 50}") for i in range(3000)] + [(i, f"own {i}") for i in range(2, 40)] + [(None, "x")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = learn.sample(docs, labels, "toxic", (10, 12), folds=10 ** 9)
    assert [y for _, y in got].count(0) == 10 and [y for _, y in got].count(1) == 12
    assert sum(t.startswith("text ") for t, _ in got) <= 1
    assert sorted(got) == sorted(learn.sample(docs.repartition(7), labels, "toxic", (10, 12), folds=10 ** 9))
    assert learn.sample(docs.limit(0), labels, "toxic", (10, 10)) == []


def _aligned(index, text):
    """Names of the templates found by aligning each of them at every word of the text."""
    ids = index.ids(licences.WORD.findall(text))
    found = []
    for k, want in enumerate(index.words):
        mine = []
        for shift in range(-licences.BAND, len(ids)):
            near = ids[max(0, shift - licences.BAND):max(0, shift + len(want) + licences.BAND)]
            if np.isin(want, near).mean() < licences.COVERAGE:
                continue  # too few of the words are there at all
            got = licences.align(want, ids, shift)
            if got is None or got[0] < licences.COVERAGE or not got[3][index.must[k]].all():
                continue
            extra = got[1] + np.flatnonzero(np.isin(ids[got[1]:got[2] + 1], index.other[k]))
            if not any(ids[p] != index.variant["library"] or p and ids[p - 1] == index.variant["gnu"] for p in extra):
                mine.append((int(got[3].sum()), got[0], index.names[k], got[1], got[2]))
        if mine:
            found.append(max(mine, key=lambda m: (m[0], -(m[4] - m[3]), -m[3])))
    return sorted(name for _, _, name, _, _ in licences.winners(found))


def test_licences_against_alignment_everywhere():
    index = licences.Index(licences.TEMPLATES)
    rng = np.random.default_rng(6)
    filler = "the river and harbour of this work were closed while rights remain under review".split()
    for name in ("MIT", "ISC", "BSD", "GPL", "MPL-2.0", "Unlicense", "MIT-notice", "Apache-2.0-notice", "CC-BY-SA-4.0-short", "MIT-SPDX"):
        words = re.findall(r"\S+", licences.TEMPLATES[name])
        if len(words) > 20:  # a changed word and one put in
            words[9] = "changed"
            words.insert(15, "inserted")
        lead, tail = rng.choice(filler, 14).tolist(), rng.choice(filler, 9).tolist()
        text = " ".join(lead + words + tail)
        assert sorted({h["license"] for h in index.find(text)}) == sorted(set(_aligned(index, text))), name
    plain = " ".join(rng.choice(filler, 60))
    assert index.find(plain) == [] and _aligned(index, plain) == []


def test_ownership_against_plain_counts(spark, small_dir):
    shared = 'password = "shared-example-1"'
    extra = [(-i, shared, f"owner {i % 5}") for i in range(1, 30)] + [(-90, 'secret: "alone-and-live-1"', "z"), (-91, None, "z"), (-92, "", None)]
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "source").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string, source string"))
    found = secrets.scan(docs, "doc_id", "source")
    held, values = defaultdict(set), {}
    for r in found.collect():
        values[r.doc_id] = [s["value"] for s in r.base + r.other]
        for v in values[r.doc_id]:
            held[v].add((r.owner, r.repo))
    want = sorted((len({o for o, _ in h}), len(h)) for h in held.values())
    assert sorted((r.owners, r.repos) for r in secrets.ownership(found).collect()) == want
    live = {v for v, h in held.items() if len({o for o, _ in h}) <= 2}
    assert "alone-and-live-1" in live and "shared-example-1" not in live
    for r in secrets.find(docs).collect():
        assert (r.n_live, r.n_example) == (sum(v in live for v in values[r.doc_id]), sum(v not in live for v in values[r.doc_id]))


def test_cover_tree_takes_single_precision_and_clashing_columns(spark):
    x = np.random.default_rng(8).normal(size=(30, 8)).astype(np.float32)
    x[20:] = x[:10] * np.float32(3)
    rows = [(i, [float(e) for e in v], i, 0, "c") for i, v in enumerate(x)] + [(30, None, 0, 0, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cid int, block int, path string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in covertree.near_duplicates(df).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9) & ~np.eye(30, dtype=bool)
    assert {i: got[i][0] for i in range(30)} == dict(enumerate(near.sum(1).tolist()))
    assert all(got[i + 20][1] == got[i][1] for i in range(10)) and got[30] == (0, 30, True)
