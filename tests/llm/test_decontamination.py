"""Decontamination: the sieve loses nothing, items too short for a template, very long texts, clashing columns."""

import random

import numpy as np
import pytest

from orderdesk.llm import decontam


@pytest.fixture(scope="module")
def items():
    rng = random.Random(8)
    words = "the of and river harbour shop box apples buys gives how many are left in her small open 7 12 kg".split()
    made = [" ".join(rng.choice(words) if rng.random() < 0.85 else rng.choice(["Alice", "Bob", "New York", "3.5", "1,200"])
                     for _ in range(rng.randrange(6, 26))) + "?" for _ in range(60)]
    return [(i, t[0].upper() + t[1:]) for i, t in enumerate(made)]


def _texts(items, rng, n):
    """Clean prose, items as they are, with other names, numbers and units, in pieces, and cut or mixed up."""
    words = "the of and river harbour shop quay mast in small open left many a ß Σίγμα ςο İx 9 kg lb".split()
    noise = lambda k: " ".join(rng.choice(words) for _ in range(k))
    out = []
    for _ in range(n):
        t = rng.choice(items)[1]
        swap = {"Alice": "Zoë", "Bob": "Tom Li", "New York": "Ulm", "3.5": "4", "1,200": "7", "12": "31", "kg": "lb", "7": "6.25"}
        kind = rng.randrange(6)
        if kind == 1:
            t = " ".join(swap.get(w, w) for w in t.split())
        elif kind == 2:
            t = " ".join(t.split()[rng.randrange(4):][:rng.randrange(1, 12)])
        elif kind == 3:
            t = t.upper() if rng.random() < 0.5 else t.lower()
        elif kind == 4:
            w = t.split()
            rng.shuffle(w)
            t = " ".join(w)
        out.append("" if kind == 5 else noise(rng.randrange(30)) + rng.choice([" ", ". ", "\n", " – "]) + t + " " + noise(rng.randrange(30)))
    return out


def test_sieve_loses_no_text(items):
    rng = random.Random(9)
    bench = decontam.Bench(items)
    texts = _texts(items, rng, 1500) + ["", "a", "é" * 50]
    passed = set(bench.sieve.passing(texts).tolist())
    assert len(passed) < len(texts)
    bench.sieve.passing = lambda t: np.arange(len(t))
    found = [i for i, x in enumerate(bench.find(texts)) if x]
    assert len(found) > 300 and set(found) <= passed


def test_rows_equal_those_of_every_text_read_whole(spark, items):
    texts = [(i, t) for i, t in enumerate(_texts(items, random.Random(10), 150))]
    texts += [(200, None), (201, ""), (202, items[3][1]), (202, items[3][1]), (None, items[4][1]),
              (203, "quay " * 900_000 + items[5][1] + " mast" * 900_000)]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in texts], "doc_id long, text string, leaks string, _leaks0 int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    plain = decontam.Bench(items)
    plain.sieve.passing = lambda t: np.arange(len(t))
    want = sorted((str(i), x["item_id"], x["coverage"], x["same_values"], x["start"], x["end"])
                  for i, t in texts for x in plain.find([t or ""])[0])
    got = decontam.leaks(docs, bench).collect()
    assert sorted((str(r.doc_id), r.item_id, r.coverage, r.same_values, r.start, r.end) for r in got) == want
    assert {"202", "203", "None"} <= {w[0] for w in want}
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns and {str(r.doc_id) for r in kept.collect()}.isdisjoint({w[0] for w in want})


def test_short_items_as_they_are_written(spark):
    bench = spark.createDataFrame([(1, "Capital of France?"), (2, "Compute 7 * 8"), (3, "Yes"), (4, ""), (5, "Name two.")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Q: Capital of France? Paris"), (2, "capital of France?"), (3, "Capital of France"),
                                  (4, "so Compute 7 * 8 now, Compute 7 * 8"), (5, "Compute 7 * 9"), (6, "Yes. Name  two. Yes"),
                                  (7, "Compute\n7 8"), (8, "XCompute 7 8")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.start, r.end, r.coverage, r.same_values) for r in decontam.leaks(docs, bench).collect()}
    assert got == {(1, 1, 3, 21, 1.0, True), (4, 2, 3, 16, 1.0, True), (6, 5, 5, 15, 1.0, True)}
