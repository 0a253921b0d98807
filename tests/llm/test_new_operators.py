"""Importance resampling, vector codes and language identification against brute force on small fixtures."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from orderdesk.llm import langid, queries, resample, vectorcode
from orderdesk.plans import compare

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, score string, _raw int, rank int"
LONG = "ab" * 40_000 + " " + "wort Ärger 9 " * 20_000


@pytest.fixture(scope="module")
def rows(spark, small_dir):
    base = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{small_dir}/documents.parquet").limit(120).collect()]
    odd = [(-1, None, "en"), (-2, "", "en"), (-3, " .,;\n", "de"), (-4, LONG, "de"), (-4, LONG, "de"), (None, base[0][1], None),
           (None, "x " * 30, "fr"), (-5, "\x00a\x00 ß-é_1 " * 9, None), (-6, "½ 12 ²", "es"), (-7, "a b " * 10, "en"), (-8, "a b " * 10, "en")]
    return base + odd


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", "clash", "clash", 1, 2) for i, t, g in rows], SCHEMA)


def _words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _drawn(rows, target, n, buckets, percent, least):
    feats = [[" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)] for w in (_words(t) for _, t, _ in rows)]
    goal = [" ".join(w[i:i + k]) for w in map(_words, target) for k in range(1, n + 1) for i in range(len(w) - k + 1)]
    s = Counter(zlib.crc32(f.encode()) % buckets for x in feats for f in x)
    t = Counter(zlib.crc32(f.encode()) % buckets for f in goal)
    big, few = s.total(), t.total()
    out = []
    for (i, text, _), x in zip(rows, feats):
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * (big + buckets) / ((s[b] + 1) * (few + buckets))))
                   for b in (zlib.crc32(f.encode()) % buckets for f in x))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(x), gain, gain + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(_words(text))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[1]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("n,buckets,percent,least", [(1, 10_000, 10, 20), (3, 64, 100, 0), (2, 997, 50, 1)])
def test_draw(spark, docs, rows, n, buckets, percent, least):
    target = ["the river AND the harbour", None, "", "wort 9 Ärger the 9"]
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resample.draw(docs, goal, percent=percent, least_words=least, buckets=buckets, max_words=n)
    got = Counter(tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect())
    assert got == _drawn(rows, target, n, buckets, percent, least)


def test_draw_empty(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resample.draw(docs.limit(0), none).count() == 0
    out = resample.draw(docs, none).collect()
    assert len(out) == docs.count() and all(r.weight is not None for r in out)


def test_position_table_equals_crc32():
    rng = np.random.default_rng(3)
    spans = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (1, 2, 3, 63, 64, 65, 128, 129, 1000, 70_001, 5)] + [bytes(300)]
    raw = np.frombuffer(b"".join(spans), dtype=np.uint8)
    end = np.cumsum([len(s) for s in spans])
    start = end - [len(s) for s in spans]
    for depth in (64, 2, 16):
        assert resample.PositionCrc(depth).of(raw, start, end).tolist() == [zlib.crc32(s) for s in spans]


def _codes(vectors, parts, entries, rounds):
    """Every entry tried for every part, in Python integers."""
    kept = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in vectors
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, v, _ in kept:
                held[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(held[k]) for c in zip(*held[k])] if k in held else e for k, e in enumerate(books[p])]
    out, sums = [], Counter()
    for i, v, g in kept:
        best = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), g))
        sums[g] += out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return Counter((i, c, e, sums[g], digest) for i, c, e, g in out)


@pytest.mark.parametrize("parts,entries,rounds", [(4, 8, 2), (2, 256, 1), (8, 3, 0)])
def test_vector_codes(spark, parts, entries, rounds):
    rng = np.random.default_rng(parts)
    vectors = [(i, rng.normal(0, 0.5, 8).round(1).tolist(), int(rng.integers(3))) for i in range(60)]
    vectors += [(100, [0.25] * 8, None), (101, [0.25] * 8, None), (101, [0.25] * 8, 2), (-1, None, 1), (-2, [0.1] * 7 + [None], 1),
                (-3, [float("nan")] + [0.0] * 7, 1), (-4, [float("inf")] + [0.0] * 7, 0), (None, [-0.3] * 8, 1), (102, [0.0] * 8, 5)]
    df = spark.createDataFrame([(i, v, g, "clash", 1) for i, v, g in vectors],
                               "vec_id long, embedding array<double>, label int, code string, _label int")
    got = vectorcode.compress(df, parts, entries, rounds)
    assert Counter(tuple(r) for r in got.collect()) == _codes(vectors, parts, entries, rounds)
    other = spark.createDataFrame([(7, [0.1] * 5, 0, "", 1), (8, [1e9] * 8, 0, "", 1), (9, [], 0, "", 1)], df.schema)
    assert Counter(tuple(r) for r in vectorcode.compress(df.union(other), parts, entries, rounds).collect()) \
        == _codes(vectors, parts, entries, rounds)
    assert vectorcode.compress(df.limit(0)).count() == 0


def test_equal_average_search_is_exact():
    rng = np.random.default_rng(1)
    entries = rng.integers(-9, 9, (40, 3))
    entries[7] = entries[3]
    x = rng.integers(-30, 30, (4000, 3))
    where, far = vectorcode.nearest(x, entries)
    d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (where == d.argmin(axis=1)).all() and (far == d.min(axis=1)).all()


@pytest.mark.parametrize("name", ["op11_resample", "op12_vectorcode"])
def test_query_equals_its_sql(spark, small_dir, name):
    df = queries.QUERIES[name](spark, small_dir)
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{small_dir}/{t}.parquet')")
    rel = con.sql(queries.ORACLES[name])
    assert compare.digest(df.columns, [tuple(r) for r in df.collect()]) == compare.digest(rel.columns, rel.fetchall())


@pytest.fixture(scope="module")
def net(docs):
    return langid.fit(docs, steps=150)


def test_language_held_out(spark, small_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert len(got) > 150 and np.mean([r.lang == r.lang_pred for r in got]) >= 0.99
    assert all(0 <= r.score <= 1 for r in got)


def test_language_windows(net):
    """The folded tables and the windows give what the plain network gives window by window."""
    texts = [b"", b"a", bytes(range(256)) * 2, "Ärger über die Brücke ".encode() * 9, b"the harbour" * 700, b"x" * langid.LENGTH]
    want = []
    for t in texts:
        total, weight = np.zeros(len(net.languages)), 0
        for at in range(0, max(1, len(t) - langid.LENGTH + langid.STRIDE), langid.STRIDE):
            piece = t[at:at + langid.LENGTH]
            window = np.frombuffer(piece.ljust(langid.LENGTH, b"\0"), dtype=np.uint8)[None]
            total, weight = total + net._softmax(net._pooled(window)[0])[0] * len(piece), weight + len(piece)
        want.append(total / max(1, weight))
    assert np.abs(net.texts(texts) - np.array(want)).max() < 1e-4


def test_language_rows(docs, rows, net):
    out = langid.predict(docs, net, ("lang_pred", "score"))
    assert [c for c in out.columns if c not in ("lang_pred", "score")] == [c for c in docs.columns if c != "score"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        letter = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letter) and (letter or r.score == 0)
    assert langid.identify(docs.limit(0)).count() == 0
    bare = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in langid.identify(bare).collect()} == {"und"}


def test_language_sample_is_bounded(spark):
    copies = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, 'one text', concat('text number a', id)) as text", "'en' as lang")
    got = langid.sample(copies, per_lang=50)
    assert len(got) == 50 and len({t for _, t in got}) == 50
