"""Embedding near-duplicates by dual traversal of cover trees.

Unit vectors link if their cosine is at least the threshold, that is if their
distance is at most ``sqrt(2 - 2 * threshold)``. The top of the tree is a net of
centres from a bounded sample; every vector falls into the cell of its nearest
centre, and cells are cut or joined into blocks of bounded size. Each block
grows its own tree of nested nets with halving radii. Pairs of blocks, then
pairs of nodes, are left out when their centres are further apart than the
threshold and both covering radii; node pairs that lie wholly within the
threshold are counted without looking inside; the rest ends in exact cosines in
double precision. A task returns, for each vector, a count and one link to the
root of its local component: never the pairs of a group. Equal vectors are one
class with a weight.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, materialise
from .graph import components

THRESHOLD = 0.9
#: Vectors of the sample that the top centres come from; centres; vectors in a block.
SAMPLE, CENTRES, BLOCK = 2048, 64, 8192
#: Radius of the cells' net, then of the nested nets inside a block.
TOP, RADII = 1.0, (0.5, 0.25, 0.125)
SLACK = 1e-4
DENSE = 1024


def units(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _apart(cos):
    return np.sqrt(np.maximum(0.0, 2 - 2 * cos))


def net(x: np.ndarray, radius: float, most: int | None = None) -> np.ndarray:
    """Greedy net: indices of centres, in order, such that every vector is within ``radius`` of one (``most``: stop there)."""
    cut = 1 - radius * radius / 2
    left, out = np.arange(len(x)), []
    while len(left):
        part = left[:512]
        near = x[part] @ x[part].T >= cut
        open_ = np.ones(len(part), dtype=bool)
        for i in range(len(part)):
            if open_[i]:
                out.append(part[i])
                if most and len(out) >= most:
                    return np.array(out)
                open_ &= ~near[i]
        new = np.array(out[-512:])
        new = new[np.isin(new, part)]
        left = left[512:]
        if len(left):
            left = left[~((x[left] @ x[new].T) >= cut).any(axis=1)]
    return np.array(out, dtype=np.int64)


class Tree:
    """Nested nets: at each level the centre of every vector; nodes know their members and covering radius."""

    def __init__(self, x: np.ndarray, paths: np.ndarray):
        self.x, self.paths = x, paths
        self.nodes = {}
        for level in range(paths.shape[1]):
            order = np.argsort(paths[:, level], kind="stable")
            at = np.flatnonzero(np.r_[True, np.diff(paths[order, level]) != 0])
            centre = paths[order[at], level]
            gap = _apart((x * x[paths[:, level]]).sum(axis=1))
            gap[paths[:, level] == np.arange(len(x))] = 0.0
            self.nodes[level] = (centre, np.maximum.reduceat(gap[order], at), np.split(order, at[1:]))


def grow(x: np.ndarray) -> np.ndarray:
    """The centre of each vector at each level; a level's centres stay centres below."""
    paths = np.zeros((len(x), len(RADII)), dtype=np.int64)
    groups = [np.arange(len(x))]
    for level, radius in enumerate(RADII):
        below = []
        for members in groups:
            if len(members) == 1:
                paths[members, level] = members
                below.append(members)
                continue
            centres = members[net(x[members], radius)]
            best, cos = np.zeros(len(members), dtype=np.int64), np.full(len(members), -2.0)
            for c in range(0, len(centres), DENSE):
                s = x[members] @ x[centres[c:c + DENSE]].T
                k = s.argmax(axis=1)
                v = s[np.arange(len(members)), k]
                best[v > cos], cos = c + k[v > cos], np.maximum(v, cos)
            own = np.searchsorted(np.sort(members), centres)
            best[np.argsort(members, kind="stable")[own]] = np.arange(len(centres))
            paths[members, level] = centres[best]
            order = np.argsort(best, kind="stable")
            cuts = np.flatnonzero(np.diff(best[order])) + 1
            below += [np.r_[g[g == paths[g[0], level]], g[g != paths[g[0], level]]] for g in np.split(members[order], cuts)]
        groups = below
    return paths


class _Join:
    """Dual traversal of two trees (or one with itself)."""

    def __init__(self, a: Tree, b: Tree, weight_a, weight_b, threshold: float):
        self.a, self.b, self.same = a, b, a is b
        self.wa, self.wb, self.threshold = weight_a, weight_b, threshold
        self.reach = math.sqrt(2 - 2 * threshold)
        self.na = len(a.x)
        self.links = np.zeros(self.na + (0 if self.same else len(b.x)))
        self.parent = list(range(len(self.links)))

    def _root(self, i):
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def _tie(self, first, rest):
        r = self._root(int(first))
        for i in rest.tolist():
            q = self._root(i)
            if q != r:
                self.parent[max(q, r)] = min(q, r)
                r = min(q, r)

    def run(self):
        (ca, ra, ma), (cb, rb, mb) = self.a.nodes[0], self.b.nodes[0]
        xa, xb = self.a.x[ca].astype(np.float32), self.b.x[cb].astype(np.float32)
        # single vectors have radius zero: one bound for all of them, bounds of their own for the other nodes
        wide_a, wide_b = np.flatnonzero(ra > 0), np.flatnonzero(rb > 0)
        thin_a, thin_b = np.flatnonzero(ra == 0), np.flatnonzero(rb == 0)
        for rows, cols in ((thin_a, thin_b), (wide_a, np.arange(len(cb))), (thin_a, wide_b)):
            for s in range(0, len(rows), DENSE):
                part = rows[s:s + DENSE]
                if not len(cols):
                    break
                reach = self.reach + SLACK + (0.0 if cols is thin_b else ra[part][:, None] + rb[cols][None, :])
                i, j = np.nonzero(xa[part] @ xb[cols].T >= (1 - SLACK - reach ** 2 / 2))
                for u, v in zip(part[i].tolist(), cols[j].tolist()):
                    if not self.same or u <= v:
                        self._pair(0, ma[u], mb[v], self.same and u == v)
        return self

    def _pair(self, level, ia, ib, one):
        """Members of two nodes: excluded, included, split by the next nets, or compared."""
        if len(ia) * len(ib) > DENSE * DENSE // 4 and level + 1 < len(RADII):
            ga, gb = self._children(self.a, ia, level + 1), ([] if one else self._children(self.b, ib, level + 1))
            gb = ga if one else gb
            if len(ga) * len(gb) <= 4096 and (len(ga) > 1 or len(gb) > 1):
                for u, (c, r, m) in enumerate(ga):
                    for v, (d, q, k) in enumerate(gb):
                        if one and v < u:
                            continue
                        gap = float(_apart(self.a.x[c] @ self.b.x[d]))
                        if gap > self.reach + r + q + 1e-7:
                            continue
                        if gap + r + q < self.reach - 1e-7:
                            self._all(m, k, one and u == v)
                        else:
                            self._pair(level + 1, m, k, one and u == v)
                return
        for s in range(0, len(ia), DENSE):
            part = ia[s:s + DENSE]
            near = self.a.x[part] @ self.b.x[ib].T >= self.threshold
            if one:
                near[part[:, None] == ib[None, :]] = False
            if near.any():
                self._count(part, ib, near, one)

    def _children(self, tree, members, level):
        centre = tree.paths[members, level]
        order = np.argsort(centre, kind="stable")
        out = []
        for g in np.split(members[order], np.flatnonzero(np.diff(centre[order])) + 1):
            c = tree.paths[g[0], level]
            out.append((c, float(_apart((tree.x[g] @ tree.x[c])).max()) if len(g) > 1 else 0.0, g))
        return out

    def _all(self, ia, ib, one):
        """Every member links with every other."""
        shift = 0 if self.same else self.na
        self.links[ia] += self.wb[ib].sum() - (self.wa[ia] if one else 0)
        if not one:
            self.links[ib + shift] += self.wa[ia].sum()
        self._tie(ia[0], np.r_[ia[1:], ib + shift])

    def _count(self, ia, ib, near, one):
        shift = 0 if self.same else self.na
        self.links[ia] += near @ self.wb[ib]
        if not one:
            self.links[ib + shift] += self.wa[ia] @ near
        left = near.any(axis=1)
        while left.any():  # components of this part, a row at a time
            i = int(left.argmax())
            rows, cols = np.zeros(len(ia), dtype=bool), np.zeros(len(ib), dtype=bool)
            front = np.zeros(len(ia), dtype=bool)
            front[i] = True
            while front.any():
                rows |= front
                new = near[front].any(axis=0) & ~cols
                cols |= new
                front = near[:, new].any(axis=1) & ~rows
            self._tie(ia[i], np.r_[ia[rows], ib[cols] + shift])
            left &= ~rows


def _top(classes: DataFrame, threshold: float):
    """Centres from a bounded sample, on the driver."""
    rows = classes.select("cid", "embedding").orderBy("cid").limit(SAMPLE).collect()
    if not rows:
        return np.zeros((0, 0))
    sizes = [len(r["embedding"]) for r in rows]
    dim = max(set(sizes), key=sizes.count)
    x = units([r["embedding"] for r in rows if len(r["embedding"]) == dim])
    return x[net(x, TOP, CENTRES)]


def _blocks(cells, centres, reach):
    """cell -> (first block, blocks); cell -> ranges of blocks it may link with."""
    place, block, room = {}, 0, 0
    for cell, count, _ in cells:
        n = -(-count // BLOCK)
        if n > 1 or count > room:
            if room and n == 1:
                block, room = block + 1, 0
            elif room:
                block, room = block + 1, 0
            place[cell] = (block, n)
            block, room = (block, BLOCK - count) if n == 1 else (block + n, 0)
        else:
            place[cell] = (block, 1)
            room -= count
    partner = {}
    for c, _, r in cells:
        partner[c] = sorted({place[d] for d, _, q in cells
                             if c < 0 and c == d or c >= 0 and d >= 0 and _apart(centres[c] @ centres[d]) <= reach + r + q + SLACK})
    return place, partner


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links (other vectors linked directly), component_id, kept (vec_id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing and are their own component; vectors of different length
    do not link; repeated rows are other vectors and link; a null vec_id never
    names a component unless all its ids are null; an empty table gives an
    empty table.
    """
    spark = df.sparkSession
    v = F.col("embedding")
    # single-precision input travels as it is; tasks compute in double precision
    single = df.select(F.col(embedding)).schema[0].dataType == T.ArrayType(T.FloatType())
    kind = "array<float>" if single else "array<double>"
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast(kind).alias("embedding"))
    sound = (v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(v, lambda e: e != 0))
    rows = rows.withColumn("cid", F.when(F.coalesce(sound, F.lit(False)), F.xxhash64(v)))
    classes = rows.where("cid is not null").groupBy("cid", "embedding").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = materialise(classes, "classes")
    centres = _top(classes, threshold)

    def assign():
        def call(vectors):
            cell, gap = np.zeros(len(vectors), dtype=np.int32), np.zeros(len(vectors))
            lists = vectors.to_pylist()
            fit = np.array([len(e) == centres.shape[1] for e in lists], dtype=bool)
            cell[~fit] = [-len(e) for e, f in zip(lists, fit) if not f]
            if fit.any():
                cos = units([e for e, f in zip(lists, fit) if f]) @ centres.T
                cell[fit], gap[fit] = cos.argmax(axis=1), _apart(cos.max(axis=1))
            return [cell, gap]
        return call

    placed = materialise(add_columns(classes, assign, ["embedding"], [("cell", T.IntegerType()), ("gap", T.DoubleType())],
                                     keep=["cid", "n", "embedding"]), "cells")
    cells = [(r[0], r[1], r[2]) for r in placed.groupBy("cell").agg(F.count(F.lit(1)), F.max("gap")).orderBy("cell").collect()]
    place, partner = _blocks(cells, centres, math.sqrt(2 - 2 * threshold))
    table = spark.createDataFrame([(c, *place[c], [list(p) for p in partner[c]]) for c in place],
                                  "cell int, first int, many int, partners array<array<int>>")  # a row per cell
    rows_ = placed.join(F.broadcast(table), "cell").withColumn("block", F.col("first") + F.pmod(F.hash("cid"), F.col("many")))
    grown_type = f"cid long, n long, embedding {kind}, block int, partners array<array<int>>, path array<long>"

    def grown(pdf):
        # vectors of another length are in cells, so in blocks, of their own or are grown apart
        out = []
        for _, part in pdf.groupby(pdf["embedding"].map(len), sort=True):
            part = part.reset_index(drop=True)
            paths = grow(units(part["embedding"]))
            ids = part["cid"].to_numpy()
            out.append(part.assign(path=[ids[p].tolist() for p in paths]))
        return pd.concat(out)[["cid", "n", "embedding", "block", "partners", "path"]]

    trees = materialise(rows_.select("cid", "n", "embedding", "block", "partners").groupBy("block").applyInPandas(grown, grown_type), "trees")
    other = F.flatten(F.transform("partners", lambda p: F.sequence(p[0], p[0] + p[1] - 1)))
    sent = trees.select("cid", "n", "embedding", "path", "block", F.explode(F.array_distinct(other)).alias("o"))
    sent = sent.select("cid", "n", "embedding", "path", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))

    def joined(key, pdf):
        out = []
        for _, same in pdf.groupby(pdf["embedding"].map(len), sort=True):
            sides = []
            for block in dict.fromkeys(key):
                part = same[same["block"] == block].drop_duplicates("cid").reset_index(drop=True)
                if not len(part):
                    break
                at = {c: i for i, c in enumerate(part["cid"].tolist())}
                paths = np.array([[at[c] for c in p] for p in part["path"]], dtype=np.int64)
                sides.append((Tree(units(part["embedding"]), paths), part["n"].to_numpy(dtype=np.float64), part["cid"].to_numpy()))
            if len(sides) < len(dict.fromkeys(key)):
                continue
            (a, wa, ids), (b, wb, _) = sides[0], sides[-1]
            j = _Join(a, b, wa, wb, threshold).run()
            ids = ids if a is b else np.r_[ids, sides[1][2]]
            hit = np.flatnonzero(j.links > 0)
            out.append(pd.DataFrame({"cid": ids[hit], "links": j.links[hit].astype(np.int64),
                                     "root": ids[[j._root(int(i)) for i in hit]] if len(hit) else ids[:0]}))
        return pd.concat(out) if out else pd.DataFrame({"cid": [], "links": [], "root": []}).astype("int64")

    found = materialise(sent.groupBy("i", "j").applyInPandas(joined, "cid long, links long, root long"), "links")
    marked = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))).withColumnsRenamed({"node": "cid"})
    per = (classes.select("cid", "n", "least").join(found.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left")
           .join(marked, "cid", "left").withColumn("component", F.coalesce("component", "cid")))
    per = materialise(per, "members")
    names = per.groupBy("component").agg(F.min("least").alias("component_id"))
    per = per.join(names, "component").select("cid", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.drop("embedding").join(per, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
