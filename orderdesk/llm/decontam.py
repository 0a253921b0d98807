"""Benchmark decontamination by template canonicalisation.

Text and benchmark items are turned into templates: numbers, names and units
become typed placeholders, other words are lower case. Windows of template
tokens are joined by hash; the windows of one item that match along one
alignment, or along shifts near it, are checked slot by slot: each value of the
item must stand for one value of the document and the other way round. So a
question whose numbers or names were replaced throughout is found as well as a
verbatim copy.

A capital at a sentence start may be a name or not. Texts and items are read in
up to three ways (no such word is a name; those the benchmark block never writes
in lower case; also those the text writes with a capital inside a sentence), and
any reading of an item may match any reading of a text.

The benchmark is taken in blocks of bounded size, each sent to the tasks as a
table of window hashes; documents never move. A sieve over the letters of a
whole batch first sets aside the texts that cannot hold a window: those without
a run of enough tokens that are each a word of the benchmark, a unit, a number
or capitalised. Items too short for a template are looked for as they are
written.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, free_name, text_of
from .repeats import _mixed, _powers

WINDOW = 8
#: Items with fewer template tokens are found only as they are written (same words, signs and capitals).
LEAST_TOKENS = 5
COVERAGE = 0.5
#: Shifts so close to an alignment belong to it (words put in or left out).
DRIFT = 8
BLOCK_CHARS = 8_000_000
CACHE_WORDS = 200_000
# a number with its separators is one token
TOKEN = re.compile(r"[.!?:;\n\"“”]|\d+(?:[.,]\d+)+\w*|\w+")
# fixed values: unit words that stand after a number
UNITS = frozenset("""kg g mg lb lbs oz t km m cm mm mi mile miles ft feet inch inches yd s sec second seconds min minute
minutes h hr hour hours day days week weeks month months year years l ml litre litres liter liters gallon gallons percent
dollar dollars usd euro euros eur cent cents mph kmh kph hz khz mhz ghz w kw mw v volt volts a amp amps j kj cal kcal
n pa kpa degree degrees c f k b kb mb gb tb""".split())
NUMBER, NAME, UNIT = 1, 2, 3
BREAK, CAPITAL, DIGITS, MEASURE, LOWER = 1, 2, 4, 8, 16
HIT = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("coverage", T.DoubleType()),
                                T.StructField("same_values", T.BooleanType()), T.StructField("start", T.IntegerType()),
                                T.StructField("end", T.IntegerType())]))


def _after(mask: np.ndarray) -> np.ndarray:
    """The mask one place to the right."""
    out = np.zeros(len(mask), dtype=bool)
    out[1:] = mask[:-1]
    return out


def _flags(token: str, low: str) -> int:
    if not (token[0].isalnum() or token[0] == "_"):
        return BREAK
    return ((CAPITAL if token[0].isupper() and not token[1:].isupper() else 0) | (DIGITS if token[0].isdigit() else 0)
            | (MEASURE if low in UNITS else 0))


def canonical(word: np.ndarray, flags: np.ndarray):
    """The readings of a text: template ids and the token index of each, from word ids and flags in text order."""
    real = np.flatnonzero((flags & BREAK) == 0)
    if not len(real):
        return [(np.zeros(0, dtype=np.int64), real)]
    f, base = flags[real], word[real].copy()
    starts = np.ones(len(real), dtype=bool)
    starts[1:] = real[1:] - real[:-1] > 1
    digits = (f & DIGITS) > 0
    capital = ((f & CAPITAL) > 0) & ~digits
    inside, first = capital & ~starts, capital & starts
    unit = ((f & MEASURE) > 0) & _after(digits) & ~starts
    rare = first & ((f & LOWER) == 0)
    also = first & np.isin(base, base[inside & (base > 0)]) if inside.any() else rare
    names = [inside]
    for more in (rare, rare | also):
        if (inside | more).sum() > names[-1].sum():
            names.append(inside | more)
    out = []
    for name in names:
        ids = base.copy()
        ids[digits], ids[name], ids[unit] = NUMBER, NAME, UNIT
        stay = ~(name & _after(name) & ~starts)  # words of one name are one slot
        out.append((ids[stay], real[stay]))
    return out


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    if len(ids) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(ids) - n + 1, dtype=np.uint64)
    u = ids.astype(np.uint64)
    for j in range(n):
        out = (out ^ (u[j:len(ids) - n + 1 + j] + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    return out


class _Letters:
    """What each code point is, for whole arrays of them: part of a word, a digit, a capital; its lower case."""

    made = None

    @classmethod
    def tables(cls):
        if cls.made is None:
            points = np.r_[np.arange(0xD800), np.arange(0xE000, 0x110000)]
            every = points.astype("<u4").tobytes().decode("utf-32-le")
            word = np.zeros(0x110000, dtype=bool)
            lower = np.arange(0x110000, dtype=np.uint32)
            free, digit = np.zeros(0x110000, dtype=bool), np.zeros(0x110000, dtype=bool)
            for m in re.finditer(r"\w+", every):
                word[points[m.start():m.end()]] = True
                for c in m.group():
                    low = c.lower()
                    lower[ord(c)] = 0x3C3 if low == "ς" else ord(low[0])  # one sigma: its form depends on its place
                    digit[ord(c)] = c.isdigit()
                    free[ord(c)] = c.isupper() or c.isdigit()
            cls.made = word, lower, free, digit
        return cls.made


class Sieve:
    """Finds the texts of a batch that may hold a window of a template: ``least`` tokens in a row, each a
    word of the benchmark or free (capitalised, a number, a unit after one), where any three words in a row
    stand so in the benchmark too. Words of a template that follow each other do so in the text, so no
    window is lost; hashes are looked up in tables of bits, so a text may pass for nothing.
    """

    WORDS, THREES, LARGEST = 22, 24, 4_000_000

    def __init__(self, items: list[str], least: int):
        self.least = least
        self.units = np.sort(self._tokens(sorted(UNITS))[1])
        self.words, self.threes = (np.zeros(1 << n, dtype=bool) for n in (self.WORDS, self.THREES))
        for s in range(0, len(items), 1000):
            text, h, _, _ = self._tokens(items[s:s + 1000])
            self.words[h >> np.uint64(64 - self.WORDS)] = True
            self.threes[self._three(h)[text[2:] == text[:-2]]] = True

    @staticmethod
    def _tokens(texts: list[str]):
        """Text, hash of the lower case, and whether it starts with a capital or digit, or a digit, of each run of letters."""
        word, lower, free, digit = _Letters.tables()
        raw = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype="<u4")
        edge = np.diff(np.r_[False, word[raw], False].astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _powers(len(raw) + 1)
        part = (lower[raw].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((part ^ (part >> np.uint64(29))) * up[:len(raw)], dtype=np.uint64)])
        h = _mixed((total[end] - total[start]) * down[start]) * np.uint64(0xD6E8FEB86659FD93)
        text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, np.cumsum([0] + [len(t) + 1 for t in texts]))))
        first = raw[start]
        return text, h, free[first], digit[first]

    def _three(self, h: np.ndarray) -> np.ndarray:
        mixed = (h[:-2] * np.uint64(0xBF58476D1CE4E5B9) ^ h[1:-1]) * np.uint64(0x94D049BB133111EB) ^ h[2:]
        return (mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.THREES)

    def passing(self, texts: list[str]) -> np.ndarray:
        """Indices of the texts that may hold a window."""
        if sum(map(len, texts)) > self.LARGEST:  # one very long text: read it as it is
            return np.arange(len(texts))
        text, h, free, digit = self._tokens(texts)
        if len(h) < self.least:
            return np.zeros(0, dtype=np.int64)
        after = np.flatnonzero(_after(digit))
        free[after[np.isin(h[after], self.units)]] = True
        known = self.words[h >> np.uint64(64 - self.WORDS)]
        place = np.arange(len(h))
        begin = np.where(free | known, 0, place + 1)  # no run goes over an unknown word
        begin[1:] = np.maximum(begin[1:], np.where(text[1:] != text[:-1], place[1:], 0))
        fixed = known & ~free
        odd = np.flatnonzero(fixed[2:] & fixed[1:-1] & fixed[:-2]) + 2
        odd = odd[~self.threes[self._three(h)[odd - 2]]]
        begin[odd] = np.maximum(begin[odd], odd - 1)
        return np.unique(text[place - np.maximum.accumulate(begin) + 1 >= self.least])


def known_windows(ids: np.ndarray, n: int):
    """Places and hashes of the windows whose words all occur in the benchmark (no other window can match)."""
    edge = np.ones(len(ids) + 2, dtype=bool)
    edge[1:-1] = ids == 0
    gap = np.flatnonzero(edge)
    length = gap[1:] - gap[:-1] - 1
    runs = np.flatnonzero(length >= n)
    if not len(runs):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    size = length[runs] - n + 1
    total = np.cumsum(size)
    at = np.repeat(gap[runs] - total + size, size) + np.arange(total[-1])
    out = np.zeros(len(at), dtype=np.uint64)
    u = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for j in range(n):
        out = (out ^ u[at + j]) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    return at, out


class Bench:
    """Templates of one block of benchmark items and their window hashes."""

    def __init__(self, items: list[tuple[int, str]]):
        self.vocab: dict[str, int] = {}
        self.memo: dict[str, int] = {}
        self.items, by_size = [], defaultdict(lambda: defaultdict(list))
        self.lower: set[str] = set()
        texts = [(item, TOKEN.findall(text)) for item, text in items]
        for _, tokens in texts:
            for t in tokens:
                self.vocab.setdefault(t.lower(), len(self.vocab) + 4)
                if t.islower():
                    self.lower.add(t)
        for item, tokens in texts:
            for ids, at in self.readings(tokens):
                if len(ids) < LEAST_TOKENS:
                    continue
                n, k = min(WINDOW, len(ids)), len(self.items)
                self.items.append((item, [tokens[i] for i in at], ids, n))
                for q, h in enumerate(window_hashes(ids, n).tolist()):
                    by_size[n][h].append((k, q))
        self.sizes = {n: (np.array(sorted(table), dtype=np.uint64), dict(table)) for n, table in by_size.items()}
        self.sieve = Sieve([text for _, text in items], min(by_size, default=WINDOW))
        # short items by their longest token; one token alone is no item
        self.short = defaultdict(list)
        for item, tokens in texts:
            real = [t for t in tokens if _flags(t, t.lower()) != BREAK]
            if len(tokens) > 1 and real and all(len(ids) < LEAST_TOKENS for ids, _ in self.readings(tokens)):
                self.short[max(real, key=len)].append((item, tokens))
        self.finder = ahocorasick.Automaton() if self.short else None
        for key in self.short:
            self.finder.add_word(key, key)
        if self.short:
            self.finder.make_automaton()

    def codes(self, tokens: list[str]):
        memo, vocab = self.memo, self.vocab
        if len(memo) > CACHE_WORDS:
            memo.clear()
        for t in set(tokens).difference(memo):
            low = t.lower()
            memo[t] = vocab.get(low, 0) << 5 | (LOWER if low in self.lower else 0) | _flags(t, low)
        both = np.fromiter(map(memo.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        return both >> 5, both & 31

    def readings(self, tokens: list[str]):
        return canonical(*self.codes(tokens))

    def find(self, texts: list[str]) -> list[list[dict]]:
        """For each text the items it contains."""
        out = [[] for _ in texts]
        for i in self.sieve.passing(texts).tolist() if self.items else []:
            text = texts[i]
            tokens = TOKEN.findall(text)
            best = {}
            for ids, at in self.readings(tokens):
                pairs = defaultdict(lambda: defaultdict(set))
                for n, (known, table) in self.sizes.items():
                    place, h = known_windows(ids, n)
                    spot = np.searchsorted(known, h)
                    for x in np.flatnonzero(known[np.minimum(spot, len(known) - 1)] == h).tolist():
                        p = int(place[x])
                        for k, q in table[int(h[x])]:
                            if (self.items[k][2][q:q + n] == ids[p:p + n]).all():
                                pairs[k][p - q].add(q)
                for k, shifts in pairs.items():
                    self._judge(k, shifts, tokens, at, best)
            if best:
                spans = [m.span() for m in TOKEN.finditer(text)]
                out[i] = [{**best[k], "start": spans[best[k]["start"]][0], "end": spans[best[k]["end"]][1]} for k in sorted(best)]
        return out

    def find_short(self, texts: list[str], out: list[list[dict]]) -> list[list[dict]]:
        """Adds the short items that stand in a text token by token."""
        for i, text in enumerate(texts if self.finder else []):
            keys = {key for _, key in self.finder.iter(text)}
            if not keys:
                continue
            tokens, best = TOKEN.findall(text), {}
            for key in sorted(keys):
                for p in [p for p, t in enumerate(tokens) if t == key]:
                    for item, want in self.short[key]:
                        at = p - want.index(key)
                        if at >= 0 and tokens[at:at + len(want)] == want:
                            best.setdefault(item, (at, at + len(want) - 1))
            if best:
                spans = [m.span() for m in TOKEN.finditer(text)]
                new = {k: {"item_id": k, "coverage": 1.0, "same_values": True, "start": spans[a][0], "end": spans[b][1]}
                       for k, (a, b) in best.items()}
                out[i] = [x for _, x in sorted(({x["item_id"]: x for x in out[i]} | new).items())]
        return out

    def _judge(self, k, shifts, tokens, at, best):
        """Slot check along each shift, alone and with the shifts near it; ``best`` keeps the widest cover of every item."""
        item, words, want, n = self.items[k]
        for shift in sorted(shifts):
            near = {q: shift for q in shifts[shift]}
            tries = [sorted(near.items())]
            for s in sorted((s for s in range(shift - DRIFT, shift + DRIFT + 1) if s in shifts), key=lambda s: (abs(s - shift), s)):
                for q in shifts[s]:
                    near.setdefault(q, s)
            if len(near) > len(tries[0]):
                tries.append(sorted(near.items()))
            for found in tries:
                forth, back, slots = defaultdict(Counter), defaultdict(Counter), {}
                for j, s in {(j, s) for q, s in found for j in range(q, q + n)}:
                    if want[j] in (NUMBER, NAME, UNIT):
                        slots[j, s] = (int(want[j]), words[j]), tokens[at[j + s]]
                for a, b in (slots[x] for x in sorted(slots)):
                    forth[a][b] += 1
                    back[b][a] += 1
                fits = {x for x, (a, b) in slots.items()
                        if forth[a].most_common(1)[0][0] == b and back[b].most_common(1)[0][0] == a}
                good = [(q, s) for q, s in found if all((j, s) in fits for j in range(q, q + n) if (j, s) in slots)]
                covered = {(j, s) for q, s in good for j in range(q, q + n)}
                share = len({j for j, _ in covered}) / len(words)
                if share < COVERAGE or item in best and best[item]["coverage"] >= share:
                    continue
                where = [at[j + s] for j, s in covered]
                best[item] = {"item_id": item, "coverage": share,
                              "same_values": all(slots[x][0][1] == slots[x][1] for x in covered if x in slots),
                              "start": min(where), "end": max(where)}


def blocks(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """The benchmark in blocks of about ``BLOCK_CHARS`` characters, one after the other."""
    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long"), text_of().alias("text")).distinct()
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_CHARS)
    for b in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").collect()]


def match(docs: DataFrame, benchmark: DataFrame, column: str = "leaks", keep=None) -> DataFrame:
    """``docs`` with ``leaks``: the benchmark items each whole text contains.

    One entry per item: item_id, coverage (share of its template tokens),
    same_values (no slot was replaced), start and end (characters). Null and
    empty texts contain nothing; items without an id or of one token are not
    looked for, those with fewer than ``LEAST_TOKENS`` template tokens only
    as they are written; rows with the same item_id are
    separate texts of one item; repeated documents each give a row; an empty
    benchmark gives empty lists. A very long text takes memory in proportion to
    its length; columns of any name pass through.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != column]
    out, found = docs, []
    for items in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def build(shared=shared):
            bench = Bench(shared.value)

            def call(texts):
                texts = [t or "" for t in texts.to_pylist()]
                return [bench.find_short(texts, bench.find(texts))]
            return call

        name = free_name(out, f"_leaks{len(found)}")
        out = add_columns(out, build, ["text"], [(name, HIT)], None if keep is None else [*dict.fromkeys([*kept, "text", *found])])
        found.append(name)
    merged = F.flatten(F.array(*[F.col(c) for c in found])) if found else F.array().cast(HIT)
    return out.select(*[F.col(f"`{c}`") for c in kept], F.array_sort(merged).alias(column))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, coverage, same_values, start, end: a row for each item a document contains."""
    found = match(docs.select("doc_id", text_of().alias("text")), benchmark, keep=["doc_id"])
    return found.select("doc_id", F.inline("leaks"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain a benchmark item."""
    column = free_name(docs, "_leaks")
    return match(docs, benchmark, column).where(F.size(column) == 0).drop(column)
