"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file is read as it is (nothing is trained). A task splits its texts
into words, encodes the words it has not met yet in one flat numpy array of
symbols, and joins the ids of each text from its words. One round finds the
best pair rank of every word by a segmented minimum, merges its leftmost
non-overlapping occurrences at once, and compacts the array; words without a
pair leave it. Rounds go on until no pair remains.

Simultaneous merging equals the library's one-at-a-time queue: an occurrence
whose new symbol would form a pair of equal or better rank with a neighbour
holds back the later occurrences near it (within twice the longest piece)
until the next round.

A word of more than ``LONG_WORD`` characters has rounds of its own: its symbols
are linked to their neighbours and its pairs lie sorted by rank, so a round
touches the pairs it merges, not the whole word.
"""

from __future__ import annotations

import heapq
import re
import struct
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns, text_of

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NONE = np.int64(1) << 40
#: No pair, and a symbol merged into another, among the 32-bit numbers of a long word.
NONE_32, GONE = np.int32(2 ** 31 - 1), np.int32(-2 ** 31)
#: Pairs looked up at once in a long word.
LONG_STEP = 1 << 18
#: Words kept per task; the cache starts anew beyond it (bounded memory).
CACHE_WORDS = 250_000
#: Words whose merge rounds run at once.
BATCH_WORDS = 50_000
#: Characters from which a word's pairs are kept by rank.
LONG_WORD = 4096


def _fields(buf: bytes):
    """(field number, value) of a serialised message."""
    i = 0

    def varint():
        nonlocal i
        shift = value = 0
        while True:
            c = buf[i]
            i += 1
            value |= (c & 127) << shift
            shift += 7
            if c < 128:
                return value

    while i < len(buf):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(tag & 7)
        n = varint() if n is None else n
        yield tag >> 3, buf[i:i + n]
        i += n


class PieceModel:
    """Tables of a BPE model: symbols, pair ranks, piece bytes."""

    def __init__(self, raw: bytes):
        pieces, kinds, scores = [], [], []
        norm, trainer = {}, {}
        for f, v in _fields(raw):
            if f == 1:
                p = dict(_fields(v))
                pieces.append(p[1].decode("utf-8"))
                scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                kinds.append(p.get(3, NORMAL))
            elif f == 2:
                trainer = dict(_fields(v))
            elif f == 3:
                norm = dict(_fields(v))
        if trainer.get(3) != 2 or norm.get(2) or norm.get(4, 1) or {USER, UNUSED} & set(kinds):
            raise ValueError("only BPE models with identity normalisation and plain pieces are supported")
        self.prefix = bool(norm.get(3, 1))
        self.unk = kinds.index(UNKNOWN)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == BYTE}
        normal = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == NORMAL}
        # symbols: piece ids, then characters that occur only inside pieces
        symbols = dict(normal)
        for p in normal:
            for c in p:
                symbols.setdefault(c, len(pieces) + len(symbols) - len(normal))
        self.n_pieces = len(pieces)
        self.char = np.full(0x110000, -1, dtype=np.int64)
        for s, i in symbols.items():
            if len(s) == 1:
                self.char[ord(s)] = i
        self.extra = {i: s for s, i in symbols.items() if i >= len(pieces)}
        order = {s: r for r, s in enumerate(sorted({-scores[i] for i in normal.values()}))}
        pairs = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                left, right = symbols.get(p[:k]), symbols.get(p[k:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = (i, order[-scores[i]])
        keys = sorted(pairs)
        self.pair_piece = np.array([pairs[k][0] for k in keys] + [0], dtype=np.int64)
        self.pair_rank = np.array([pairs[k][1] for k in keys] + [NONE], dtype=np.int64)
        # open addressing: slot -> number of the pair; every pair lies within ``probes`` of its slot
        self.bits = max(4, (8 * len(keys)).bit_length())
        self.slot_key = np.full((1 << self.bits) + 64, -1, dtype=np.int64)
        self.slot_pair = np.full((1 << self.bits) + 64, len(keys), dtype=np.int64)
        self.probes = 1
        for i, (k, at) in enumerate(zip(keys, self._slot(np.array(keys, dtype=np.int64)).tolist())):
            far = at
            while self.slot_key[far] != -1:
                far += 1
            self.slot_key[far], self.slot_pair[far] = k, i
            self.probes = max(self.probes, far - at + 1)
        self.reach = 2 * max(map(len, normal), default=1)
        cuts = any(p[j] != SPACE and p[j + 1] == SPACE for p in normal for j in range(len(p) - 1))
        inside = set("".join(normal))
        alone = "".join(c for c in "\n\t\r" if c not in inside)
        # a letter and a mark that never stand together in a piece are never merged
        letter = re.compile(r"[^\W\d_]")
        joined = {b for p in normal for a, b in zip(p, p[1:]) if letter.match(a)}
        marks = "".join(re.escape(c) for c in ".,!?;:%*#&$|" if c not in joined)
        parts = [f"[{alone}]"] * bool(alone) + [rf"{SPACE}*[^\W\d_]+(?=[{marks}])"] * bool(marks)
        self.split = None if cuts else re.compile("|".join([*parts, f"{SPACE}*[^{SPACE}{alone}]+", f"{SPACE}+"]))
        self.decimal = [str(i) for i in range(len(pieces))]
        blob = []
        for p, k in zip(pieces, kinds):
            blob.append(bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL
                        else " ⁇ ".encode() if k == UNKNOWN else p.replace(SPACE, " ").encode())
        self.piece_len = np.array([len(b) for b in blob], dtype=np.int64)
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self.blob = np.frombuffer(b"".join(blob), dtype=np.uint8)
        self.opens = np.array([k == NORMAL and p.startswith(SPACE) for p, k in zip(pieces, kinds)])

    # ---- encoding -------------------------------------------------------
    def words(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(" ", SPACE)
        text = SPACE + text if self.prefix else text
        return self.split.findall(text) if self.split else [text]

    def _lookup(self, left, right):
        key = np.where((left >= 0) & (right >= 0), (left << 20) | right, -2)
        at = self._slot(key)
        found = self.slot_key[at]
        pair = np.where(found == key, self.slot_pair[at], len(self.pair_rank) - 1)
        open_ = np.flatnonzero((found != key) & (found != -1))
        for k in range(1, self.probes):
            if not len(open_):
                break
            found = self.slot_key[at[open_] + k]
            hit = found == key[open_]
            pair[open_[hit]] = self.slot_pair[at[open_[hit]] + k]
            open_ = open_[~hit & (found != -1)]
        return self.pair_rank[pair], self.pair_piece[pair]

    def _slot(self, key):
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as the bytes of an int32 array."""
        short = [w for w in words if len(w) <= LONG_WORD]
        if len(short) < len(words):
            made = iter(self.encode_words(short) if short else ())
            return [next(made) if len(w) <= LONG_WORD else self.encode_long(w) for w in words]
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        sym = self.char[codes]
        sym = np.where(sym < 0, -2 - codes, sym)
        place = np.arange(len(sym))
        done = []
        rank, made = self._lookup(sym[:-1], sym[1:])
        rank = np.where(word[:-1] == word[1:], rank, NONE)
        while len(sym) > 1:
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(np.r_[rank, NONE], first)
            ahead = np.repeat(best, np.diff(np.r_[first, len(sym)]))
            live = ahead < NONE
            if not live.all():
                done.append((word[~live], place[~live], sym[~live]))
                if not live.any():
                    sym = sym[:0]
                    break
                # words leave as a whole; the pair across the gap is no pair
                sym, word, place, ahead = sym[live], word[live], place[live], ahead[live]
                rank, made = np.r_[rank, NONE][live][:-1], np.r_[made, 0][live][:-1]
                rank = np.where(word[:-1] == word[1:], rank, NONE)
            cand = np.flatnonzero(rank == ahead[:-1])
            run = np.r_[True, np.diff(cand) > 1]
            run_at = np.maximum.accumulate(np.where(run, np.arange(len(cand)), 0))
            pick = cand[(np.arange(len(cand)) - run_at) % 2 == 0]
            # pairs that the new symbol would form with its neighbours
            now = rank[pick]
            prod = made[pick]
            n = len(sym)
            right = np.where((pick + 2 < n) & (word[np.minimum(pick + 2, n - 1)] == word[pick]),
                             sym[np.minimum(pick + 2, n - 1)], -1)
            left = np.where((pick > 0) & (word[np.maximum(pick - 1, 0)] == word[pick]), sym[np.maximum(pick - 1, 0)], -1)
            touch = np.r_[False, np.diff(pick) == 2] & (left != -1)
            left = np.where(touch, np.r_[0, prod[:-1]], left)
            halt = (self._lookup(prod, right)[0] <= now) | (self._lookup(left, prod)[0] <= now)
            if halt.any():
                apart = np.r_[True, (word[pick[1:]] != word[pick[:-1]]) | (np.diff(place[pick]) > self.reach)]
                before = np.cumsum(halt) - halt
                base = np.maximum.accumulate(np.where(apart, before, 0))
                pick, prod = pick[before == base], prod[before == base]
            sym = sym.copy()
            sym[pick] = prod
            stay = np.ones(n, dtype=bool)
            stay[pick + 1] = False
            new = np.zeros(n, dtype=bool)
            new[pick] = True
            rank, made = np.r_[rank, NONE][stay][:-1], np.r_[made, 0][stay][:-1]
            sym, word, place, new = sym[stay], word[stay], place[stay], new[stay]
            redo = np.flatnonzero(new[:-1] | new[1:])  # only pairs beside a merge have changed
            again, made[redo] = self._lookup(sym[redo], sym[redo + 1])
            rank[redo] = np.where(word[redo] == word[redo + 1], again, NONE)
        if len(sym):
            done.append((word, place, sym))
        if not done:
            return [b""] * len(words)
        word, place, sym = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(place, kind="stable")
        return self._ids(word[order], sym[order], len(words))

    def encode_long(self, word: str) -> bytes:
        """Ids of one word by the same rounds, over linked symbols and pairs kept by rank."""
        codes = np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.int64)
        n = len(codes)
        sym = self.char[codes]
        sym = np.append(np.where(sym < 0, -2 - codes, sym), -1).astype(np.int32)  # place n: the end
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        rank, made = np.full(n + 1, NONE_32, dtype=np.int32), np.zeros(n + 1, dtype=np.int32)
        queue, held = [], {}

        def pairs(at):
            """Look up the pairs that begin at these places and keep them by rank."""
            r, m = self._lookup(sym[at].astype(np.int64), sym[after[at]].astype(np.int64))
            rank[at], made[at] = np.minimum(r, NONE_32), m
            at, r = at[r < NONE], r[r < NONE]
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else r
            for a, b, k in zip(first.tolist(), [*first[1:].tolist(), len(r)], r[first].tolist()):
                if k in held:
                    held[k].append(at[a:b])
                else:
                    held[k] = [at[a:b]]
                    heapq.heappush(queue, k)

        for c in range(0, n, LONG_STEP):
            pairs(np.arange(c, min(n, c + LONG_STEP)))
        while queue:
            best = heapq.heappop(queue)
            cand = np.concatenate(held.pop(best))
            cand = np.unique(cand[rank[cand] == best])
            if not len(cand):
                continue
            run = np.r_[True, after[cand[:-1]] != cand[1:]]
            run_at = np.maximum.accumulate(np.where(run, np.arange(len(cand)), 0))
            pick = cand[(np.arange(len(cand)) - run_at) % 2 == 0]
            gone = after[pick]
            prod = made[pick].astype(np.int64)
            # pairs that the new symbol would form with its neighbours
            right = sym[after[gone]].astype(np.int64)
            left = np.where(pick > 0, sym[before[pick]], -1).astype(np.int64)
            touch = np.r_[False, after[gone[:-1]] == pick[1:]]
            left = np.where(touch, np.r_[0, prod[:-1]], left)
            halt = (self._lookup(prod, right)[0] <= best) | (self._lookup(left, prod)[0] <= best)
            if halt.any():
                apart = np.r_[True, np.diff(pick) > self.reach]
                earlier = np.cumsum(halt) - halt
                base = np.maximum.accumulate(np.where(apart, earlier, 0))
                go = earlier == base
                pick, gone, prod = pick[go], gone[go], prod[go]
            if len(pick) < len(cand):  # what was not merged is looked at again
                held[best] = [cand]
                heapq.heappush(queue, best)
            beyond = after[gone]
            sym[pick], rank[gone] = prod, NONE_32
            after[pick], before[beyond] = beyond, pick
            pairs(np.unique(np.r_[pick, before[pick][before[pick] >= 0]]))
            sym[gone] = GONE
        sym = sym[:n][sym[:n] != GONE].astype(np.int64)
        return self._ids(np.zeros(len(sym), dtype=np.int64), sym, 1)[0]

    def _ids(self, word, sym, n) -> list[bytes]:
        odd = np.flatnonzero((sym < 0) | (sym >= self.n_pieces))
        if len(odd):  # characters without a piece: their UTF-8 bytes
            spell = []
            for s in sym[odd].tolist():
                c = chr(-2 - s) if s < 0 else self.extra[s]
                spell.append([self.byte_ids[b] for b in c.encode()] if self.byte_ids else [self.unk])
            count = np.ones(len(sym), dtype=np.int64)
            count[odd] = [len(x) for x in spell]
            at = np.cumsum(count) - count
            word, wide = np.repeat(word, count), np.repeat(sym, count)
            for i, x in zip(at[odd].tolist(), spell):
                wide[i:i + len(x)] = x
            sym = wide
        ids = sym.astype("<i4").tobytes()
        ends = np.searchsorted(word, np.arange(n + 1)) * 4
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    # ---- decoding -------------------------------------------------------
    def decode_flat(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of the id lists ids[offsets[i]:offsets[i + 1]]."""
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= self.n_pieces):
            raise ValueError("id outside the model")
        n = self.piece_len[ids]
        ends = np.r_[0, np.cumsum(n)]
        out = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if a == b:
                out.append("")
                continue
            part, size = ids[a:b], n[a:b]
            src = np.repeat(self.piece_at[part] - (ends[a:b] - ends[a]), size) + np.arange(ends[b] - ends[a])
            raw = self.blob[src].tobytes()
            if self.prefix and self.opens[part[0]]:
                raw = raw[1:]
            out.append(raw.decode("utf-8", errors="replace"))
        return out


class Coder:
    """Encodes whole texts of one task; words met before are taken from a bounded cache."""

    def __init__(self, model: PieceModel):
        self.model, self.ids = model, {}

    def _learn(self, rows: list[list[str]]) -> None:
        new = {w for ws in rows for w in ws if w not in self.ids}
        if len(self.ids) + len(new) > CACHE_WORDS and self.ids:
            self.ids = {}
            new = {w for ws in rows for w in ws}
        new = list(new)
        for at in range(0, len(new), BATCH_WORDS):
            part = new[at:at + BATCH_WORDS]
            self.ids.update(zip(part, self.model.encode_words(part)))

    def texts(self, texts):
        """For each text its ids as an int32 array."""
        rows = [self.model.words(t or "") for t in texts]
        self._learn(rows)
        for ws in rows:
            yield np.frombuffer(b"".join(map(self.ids.__getitem__, ws)), dtype="<i4")


_MODELS: dict[bytes, PieceModel] = {}


def load(raw: bytes) -> PieceModel:
    """The tables of a model file's bytes, parsed once per worker."""
    key = raw[-64:] + str(len(raw)).encode()
    if key not in _MODELS:
        _MODELS[key] = PieceModel(raw)
    return _MODELS[key]


def model_bytes(path: str) -> bytes:
    """The model file (a parameter; a few hundred kB)."""
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", keep=None) -> DataFrame:
    """``df`` with ``ids`` array<int>: the pieces of the whole text, no begin or end ids.

    Null and empty texts give an empty list; repeated rows and extra columns
    pass through; a column named like ``ids`` is replaced; an empty table gives
    an empty table.
    """
    shared = df.sparkSession.sparkContext.broadcast(model_bytes(model_path))

    def build():
        coder = Coder(load(shared.value))

        def call(texts):
            out = list(coder.texts(texts.to_pylist()))
            ends = np.r_[0, np.cumsum([len(x) for x in out])].astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out)))]

        return call

    return add_columns(df, build, [text], [(ids, T.ArrayType(T.IntegerType()))], keep)


def decode(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded", keep=None) -> DataFrame:
    """``df`` with ``text``: the text of the id lists; null and empty lists give the empty text."""
    shared = df.sparkSession.sparkContext.broadcast(model_bytes(model_path))

    def build():
        model = load(shared.value)

        def call(lists):
            lists = lists.fill_null([]) if lists.null_count else lists
            offsets = np.asarray(lists.offsets)
            return [model.decode_flat(np.asarray(lists.values), offsets)]

        return call

    return add_columns(df, build, [ids], [(text, T.StringType())], keep)


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Digests of encoding and decoding every whole text, in one pass over the texts.

    Per row: doc_id, n_tokens, ids_sha256, decoded_sha256. Nulls, repeats and
    empty tables as in ``encode`` and ``decode``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model_bytes(model_path))

    def build():
        model = load(shared.value)
        coder = Coder(model)

        def call(texts):
            n, said, back = [], [], []
            for ids in coder.texts(texts.to_pylist()):
                n.append(len(ids))
                said.append(sha256(",".join([model.decimal[i] for i in ids.tolist()]).encode()).hexdigest())
                back.append(sha256(model.decode_flat(ids, np.array([0, len(ids)]))[0].encode()).hexdigest())
            return [n, said, back]

        return call

    return add_columns(docs.select("doc_id", text_of().alias("text")), build, ["text"],
                       [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())],
                       keep=["doc_id"])
