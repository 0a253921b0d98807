"""The corpus pipeline against a plain Python version of its stages, on planted rows, nulls and empty tables."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from orderdesk.llm import decontam, queries, secrets, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "A train leaves at 40 km and returns to Paris after 12 hours on the same old line, says Bob."


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def fingerprint(text):
    w = words(text)
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def one_of_each_group(rows):
    prints = [fingerprint(r["text"]) for r in rows]
    seen, group = sorted(set(prints)), {}
    for start in seen:
        todo = [] if start in group else [start]
        while todo:
            f = todo.pop()
            if f not in group:
                group[f] = start
                todo += [g for g in seen if g not in group and bin(f ^ g).count("1") <= 3]
    best = {}
    for r, f in zip(rows, prints):
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        if group[f] not in best or key < best[group[f]][0]:
            best[group[f]] = (key, r)
    return [r for _, r in best.values()]


def template(text):
    out, start = [], True
    for t in decontam.TOKEN.findall(text or ""):
        if not (t[0].isalnum() or t[0] == "_"):
            start = True
            continue
        if t[0].isdigit():
            kind = "<number>"
        elif t[0].isupper() and not t[1:].isupper() and not start:
            kind = "<name>"
        elif t.lower() in decontam.UNITS and not start and last[0].isdigit():
            kind = "<unit>"
        else:
            kind = t.lower()
        if not (kind == "<name>" and not start and named):
            out.append((kind, t))
        named, last, start = kind == "<name>", t, False
    return out


def contains(doc, item):
    n = min(decontam.WINDOW, len(item))
    for shift in range(1 - len(item), len(doc)):
        hits = [q for q in range(len(item) - n + 1) if 0 <= q + shift <= len(doc) - n
                and all(doc[q + shift + j][0] == item[q + j][0] for j in range(n))]
        if not hits:
            continue
        forth, back, slots = defaultdict(Counter), defaultdict(Counter), {}
        for j in sorted({j for q in hits for j in range(q, q + n)}):
            if item[j][0] in ("<number>", "<name>", "<unit>"):
                slots[j] = item[j], doc[j + shift][1]
                forth[item[j]][doc[j + shift][1]] += 1
                back[doc[j + shift][1]][item[j]] += 1
        fits = {j for j, (a, b) in slots.items() if forth[a].most_common(1)[0][0] == b and back[b].most_common(1)[0][0] == a}
        good = [q for q in hits if all(j in fits for j in range(q, q + n) if j in slots)]
        if len({j for q in good for j in range(q, q + n)}) / len(item) >= decontam.COVERAGE:
            return True
    return False


def without_leaks(rows, benchmark):
    items = [t for t in (template(text) for _, text in benchmark) if len(t) >= decontam.LEAST_TOKENS]
    return [r for r in rows if not any(contains(template(r["text"]), i) for i in items)]


def redacted(rows):
    kinds = [(secrets.ASSIGN, 2, 8), (secrets.ACCESS, 0, 16), (secrets.HEX, 0, 32), (secrets.OTHER, 0, 16)]
    found, owners = [], defaultdict(set)
    for r in rows:
        spans = [(m.start(), k, m.end(), m[g]) for k, (p, g, least) in enumerate(kinds)
                 for m in re.finditer(p, r["text"] or "", re.A) if len(m[g]) >= least]
        base = [s for s in spans if s[1] < 3]
        spans = base + [s for s in spans if s[1] == 3 and not any(b[0] < s[2] and s[0] < b[2] for b in base)]
        for s in spans:
            owners[s[3]].add(r["source"])
        found.append(sorted(spans))
    out = []
    for r, spans in zip(rows, found):
        text, pos, parts = r["text"] or "", 0, []
        for _, _, end, value in spans:
            if len(owners[value]) <= 2:
                if end - len(value) >= pos:
                    parts += [text[pos:end - len(value)], "[SECRET]"]
                pos = max(pos, end)
        out.append((r["doc_id"], "".join(parts) + text[pos:]))
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    sf = "/root/testdata/sf0.01"
    base = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(300).collect()
    long = max(base, key=lambda r: len(r["text"] or ""))["text"]
    first = long.index(" ", 40)
    planted = [(1_000_000, long, "en", "s1", 1), (1_000_001, long[:first] + " changed" + long[first:], None, None, None),
               (1_000_002, f"Some words before it. {ITEM} Some words after it.", "en", "s2", 1),
               (1_000_003, "Well, here goes. " + ITEM.replace("40", "55").replace("Paris", "Rome").replace("Bob", "Eve"), "en", "s2", 1),
               (1_000_004, "A train leaves and arrives where another line was, at the same old place.", "en", "s2", 1),
               (1_000_005, "my password = hunter2hunter2 and AKIAABCDEFGHIJKL12 " + "0a" * 20 + " end é\U0001f600 token: abcdefgh12", "en", "s3", 1),
               (1_000_006, None, None, None, None), (1_000_007, "", None, None, None), (None, "a text without an id at all here", None, None, None),
               (1_000_008, " \t\n", "en", "s4", 3), (1_000_009, "shortest", "en", "s4", 3), (1_000_009, "shortest", "en", "s4", 3)]
    planted += [(1_000_100 + i, f"copied example number {i} " * (i + 1) + "api_key=EXAMPLEEXAMPLE1", "en", f"o{i}", 1) for i in range(4)]
    rows = [tuple(r) for r in base] + planted
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").limit(15).collect()] + [(900, ITEM), (901, "too short"), (902, None)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, bench


def test_pipeline_against_plain_python(spark, tables):
    import sentencepiece
    path, rows, bench = tables
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels), "score").collect()
    stage = [r.asDict() for r in scored if r["score"] < 0.5]
    assert 0 < len(rows) - len(stage) < len(rows) / 4
    stage = one_of_each_group(stage)
    kept = {r["doc_id"] for r in stage}
    assert not {1_000_000, 1_000_001} & kept and len(kept & {1_000_006, 1_000_007, 1_000_008}) == 1
    stage = without_leaks(stage, bench)
    assert not {1_000_002, 1_000_003} & {r["doc_id"] for r in stage} and 1_000_004 in {r["doc_id"] for r in stage}
    texts = redacted(stage)
    assert "hunter2" not in dict(texts)[1_000_005] and "EXAMPLEEXAMPLE1" in dict(texts)[1_000_101]
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECE_MODEL))
    want = Counter()
    for i, t in texts:
        ids = sp.encode(t)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()] += 1
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, path).collect())
    assert got == want


def test_stages_keep_the_columns_of_documents(spark, tables):
    """Extra columns, helper names among them, pass every stage but the last and change no row."""
    path, _, _ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet").where("doc_id >= 1000000 or doc_id is null or doc_id < 60")
    wide = docs.withColumns({c: F.lit(f"clash {c}") for c in (
        "fp", "_toxicity", "leaks", "_leaks", "_leaks0", "marks", "h", "owner", "score", "_id", "_th", "_cut", "_row", "_in0", "group")})
    for name, stage in corpus_pipeline.STAGES:
        plain, full = stage(spark, docs, path), stage(spark, wide, path)
        if name != "tokens":
            assert plain.columns == docs.columns and full.columns == wide.columns, name
            assert full.where(" or ".join(f"{c} <> 'clash {c}'" for c in wide.columns[5:])).count() == 0, name
        assert Counter(map(str, full.select(*plain.columns).collect())) == Counter(map(str, plain.collect())), name


def test_empty_tables(spark, tables, tmp_path):
    path, rows, _ = tables
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
        keep = spark.read.parquet(f"{path}/{t}.parquet")
        (keep.where("doc_id >= 1000000") if t == "documents" else keep.limit(0)).write.parquet(f"{tmp_path}/docs/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, f"{tmp_path}/docs").collect()}
    # without labels nothing is toxic, without a benchmark nothing leaks
    assert {1_000_002, 1_000_004, 1_000_005, 1_000_009} <= ids
