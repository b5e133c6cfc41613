"""SimHash fingerprints, linked within a Hamming radius by BK-trees.

Distinct fingerprints are sharded by pigeonhole keys: with the bits cut into
radius + 2 blocks, two fingerprints that differ in at most `radius` bits agree in two
blocks at least, so they share the shard of one pair of blocks.  Each shard's
fingerprints become BK-trees, whose children are keyed by the integer Hamming distance
to their parent, and a search follows only the edges within the radius of its own
distance.  A shard with more than TREE fingerprints is cut into several trees by a
hash, and each tree meets the queries of one other tree's size at a time.  Trees
travel to their queries in one exchange, so a unit of work is bounded and no tree is
sent to the whole cluster (a broadcast of all trees would grow with the corpus).

Inside a task the links found are reduced to a spanning star, so a group of n close
fingerprints yields n rows, not n squared; no link between components is lost.
Components are found in Spark over fingerprints; links, components and fingerprints
never come to the driver.

Defined results: a null or empty text has fingerprint zero and links like any other;
fewer words than a shingle make one shingle; rows that repeat a doc_id each keep a row
and are one document; rows without a doc_id get a fingerprint and take part as links,
but never give a component its id (one of only such rows has none); an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, small, stage, tidy
from .components import components

TREE, STEP, UNITS = 4096, 1 << 21, 200_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at : at + 65536], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp), fp the 64 bits as a signed long."""

    def run(batches):
        for b in batches:
            out = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(out, np.uint64).view(np.int64), pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), "doc_id long, fp long")


def blocks(radius: int) -> list[tuple[int, int]]:
    """Each pair of blocks as a bit mask, and its number."""
    cuts = [64 * i // (radius + 2) for i in range(radius + 3)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [(masks[a] | masks[b], i) for i, (a, b) in enumerate(combinations(range(radius + 2), 2))]


class Forest:
    """BK-trees over the items of several shards, grown and searched level by level.

    item: fingerprints; shard: non-decreasing numbers.  A node is an item's position."""

    def __init__(self, item: np.ndarray, shard: np.ndarray):
        self.item = item
        at = np.arange(len(item))
        first = np.concatenate(([True], shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, bool)
        self.roots, self.root_shard = at[first], shard[first]
        parent = np.repeat(self.roots, np.diff(np.append(self.roots, len(item))))
        left = at[~first]
        parent = parent[~first]
        edges = []
        while len(left):  # of those that share parent and distance, the first becomes the child, the rest go below it
            d = np.bitwise_count(item[left] ^ item[parent]).astype(np.int64)
            order = np.lexsort((left, d, parent))
            left, parent, d = left[order], parent[order], d[order]
            new = np.concatenate(([True], (parent[1:] != parent[:-1]) | (d[1:] != d[:-1])))
            edges.append(np.stack([parent[new], d[new], left[new]]))
            child = left[np.flatnonzero(new)[np.cumsum(new) - 1]]
            left, parent = left[~new], child[~new]
        e = np.concatenate(edges, axis=1) if edges else np.zeros((3, 0), np.int64)
        e = e[:, np.argsort(e[0] * 65 + e[1], kind="stable")]
        self.edge, self.child = e[0] * 65 + e[1], e[2]

    def within(self, query: np.ndarray, root: np.ndarray, radius: int):
        """Yield arrays (query position, node) of all pairs within the radius."""
        for at in range(0, len(query), STEP >> 6):
            q = np.arange(at, min(len(query), at + (STEP >> 6)))
            node = root[q]
            while len(q):
                d = np.bitwise_count(query[q] ^ self.item[node]).astype(np.int64)
                hit = d <= radius
                if hit.any():
                    yield q[hit], node[hit]
                lo = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0))
                hi = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), side="right")
                n = hi - lo
                q = np.repeat(q, n)
                node = self.child[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest position that each of n reaches over the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


QUERY, IN_TREE, BOTH = 0, 1, 2


def _star(fp: np.ndarray, key: np.ndarray, role: np.ndarray, radius: int):
    """Links between the trees' items and the queries of the same key, as (fp, smallest fp reached)."""
    order = np.lexsort((fp, key))
    fp, key, role = fp[order], key[order], role[order]
    shard = np.cumsum(np.concatenate(([0], key[1:] != key[:-1]))) if len(key) else key
    t = np.flatnonzero(role != QUERY)
    forest = Forest(fp[t], shard[t])
    q = np.flatnonzero((role != IN_TREE) & np.isin(shard, forest.root_shard))
    root = forest.roots[np.searchsorted(forest.root_shard, shard[q])]
    values, number = np.unique(fp, return_inverse=True)
    label = np.arange(len(values))
    for a, b in forest.within(fp[q], root, radius):
        x, y = label[number[q[a]]], label[number[t[b]]]
        new = x != y
        if new.any():
            joined = _spanning(x[new], y[new], len(values))
            label = joined[label]
    far = np.flatnonzero(label != np.arange(len(values)))
    return values[far].view(np.int64), values[label[far]].view(np.int64)


def links(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """(u, v): edges over the column fp that connect what the links within the radius connect."""
    pairs = F.array(*[F.struct(F.lit(i).alias("pair"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("part")) for m, i in blocks(radius)])
    keyed = distinct.select("fp", F.explode(pairs).alias("k")).select("fp", "k.*")
    shared = stage(keyed.groupBy("pair", "part").count().filter("count > 1"), "shards")
    crowded = shared.filter(F.col("count") > TREE).withColumn("trees", F.ceil(F.col("count") / TREE).cast("int")).select("pair", "part", "trees")
    keyed = keyed.join(shared.select("pair", "part"), ["pair", "part"], "left_semi").join(crowded, ["pair", "part"], "left")
    trees = F.coalesce("trees", F.lit(1))
    keyed = keyed.withColumn("own", F.pmod(F.xxhash64("fp"), trees).cast("int"))
    # unit (a, b), a <= b: the tree of part b and the fingerprints of part a as queries, so each two parts meet once
    own, t = F.col("own"), F.col("t")
    dealt = keyed.select("fp", "pair", "part", "own", F.explode(F.sequence(F.lit(0), trees - 1)).alias("t"))
    role = F.when(t == own, F.lit(BOTH)).when(t > own, F.lit(QUERY)).otherwise(F.lit(IN_TREE))
    dealt = dealt.select("fp", F.xxhash64("pair", "part", F.least(t, own), F.greatest(t, own)).alias("key"), role.alias("role")).repartition("key").sortWithinPartitions("key")

    def stars(held):
        fp, key, role = (np.concatenate(c) for c in zip(*held))
        u, v = _star(fp.view(np.uint64), key, role, radius)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def run(batches):
        held, n = [], 0  # whole keys, some UNITS rows at a time; a key has two parts of a shard at most
        for b in batches:
            cols = tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero(np.diff(cols[1])) + 1
            if n >= UNITS and len(cols[1]):
                end = 0 if held[-1][1][-1] != cols[1][0] else int(cuts[0]) if len(cuts) else len(cols[1])
                held.append(tuple(c[:end] for c in cols))
                if end < len(cols[1]):
                    yield stars(held)
                    held, n, cols = [], 0, tuple(c[end:] for c in cols)
                else:
                    cols = tuple(c[end:] for c in cols)
            if len(cols[1]):
                held.append(cols)
                n += len(cols[1])
        if held:
            yield stars(held)

    return dealt.mapInArrow(tidy(run), "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links."""
    prints = stage(fingerprints(docs, shingle), "prints")
    first = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(first.select("fp"), radius))
    named = first.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stage(named.join(least, "root").select("fp", "component_id"), "classes")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def query(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = 5, radius: int = 7) -> DataFrame:
    """docs without those that link to a smaller doc_id, directly or over others.  Rows without a doc_id stay."""
    found = near_duplicates(docs, shingle, radius)
    gone = small(stage(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(), "copies"))
    return docs.join(gone, docs["doc_id"] == F.col("__gone"), "left_anti")
