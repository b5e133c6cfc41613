"""Removal of long repeated spans by compaction of a de Bruijn graph of words.

Nodes are word k-mers: of the k-mers in each window of `span` words the one with the
least hash, which depends on the window's words alone, so equal windows have equal
nodes.  An edge leads from a text's node to its next one; it stands for the words of all
windows of its node there, is named by a 128-bit hash of these words, and knows the edge
that follows it.  A shuffle tells which nodes and edges repeat in another document; all
others are left behind there.

Repeated edges are compacted through joins: an edge and its follower are nonbranching if
each occurs as often as the other and always together, and the chains of nonbranching
pairs are found as components in Spark.  Each chain is one path, which a text always
takes as a whole.  Where a node has several edges, paths branch; the windows of each
distinct edge there are taken one by one.

Source coordinates then verify: the words of every path and window are read again from
the texts at their coordinates, and two are the same only if a cryptographic digest of
their words is.  A word goes if a window that covers it also starts in a document with a
smaller doc_id.  What is kept is the corpus's repeats alone: one row for each path of a
text, not for each of its words.

Defined results: a null or empty text has no words; rows without a doc_id are nobody's
source and keep all words; rows that repeat a doc_id are one document for comparison,
each with its own text; texts shorter than a window keep all words; an empty table
gives no rows; extra columns are carried along by `remove`, but for text, n_words,
n_removed and kept_sha256, which it makes anew.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage, tidy, unstage
from .components import components

SPAN, K = 50, 16
#: An odd multiplier of a rolling hash modulo 2^64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        p = np.full(max(n, 1 << 16), base, np.uint64)
        p[0] = 1
        _powers[base] = np.multiply.accumulate(p)
    return _powers[base][:n]


class Words:
    """The words of a text, one space between them, and where each starts and ends."""

    def __init__(self, text: str | None):
        self.words = (text or "").encode().split()
        self.line = b" ".join(self.words)
        sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes

    def __len__(self):
        return len(self.words)

    def text(self, first: int, last: int) -> bytes:
        """Words first to last - 1."""
        return self.line[self.starts[first] : self.ends[last - 1]]

    def paths(self, span: int = SPAN, k: int = K):
        """Arrays (node, first window, windows): each window belongs to its least k-mer."""
        n = len(self.words)
        if n < span:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = min(k, span)
        data = np.frombuffer(self.line, np.uint8).astype(np.uint64) + np.uint64(1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(data * _power(BASE, len(data)), dtype=np.uint64)))
        s, e = self.starts[: n - k + 1], self.ends[k - 1 :]
        h = (total[e] - total[s]) * _power(INVERSE, len(data))[s]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
        width = span - k + 1
        owner = np.concatenate([np.lib.stride_tricks.sliding_window_view(h[at : at + 8192 + width - 1], width).argmin(axis=1) + at for at in range(0, len(h) - width + 1, 8192)])
        owner += np.arange(len(owner)) % 8192
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        return h[owner[first]], first, np.diff(np.append(first, len(owner)))


def _edges(span: int, k: int):
    """(node, edge, next, doc_id, row, at, n): an edge stands for n windows from word `at` on."""

    def run(batches):
        for b in slices(batches):
            node, edge, after, doc, row, at, n = [], [], [], [], [], [], []
            for d, own, text in zip(*(c.to_pylist() for c in b.columns)):
                w = Words(text)
                nodes, first, windows = w.paths(span, k)
                if not len(nodes):
                    continue
                named = [xxhash.xxh3_128_digest(w.line[a:c]) for a, c in zip(w.starts[first].tolist(), w.ends[first + windows + span - 2].tolist())]
                node.append(nodes.view(np.int64))
                edge += named
                after += [edge_id(e) for e in named[1:]] + [None]
                doc.append(np.full(len(nodes), d, np.int64))
                row.append(np.full(len(nodes), own, np.int64))
                at.append(first.astype(np.int32))
                n.append(windows.astype(np.int32))
            join = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0, t))
            yield pa.RecordBatch.from_arrays(
                [join(node, np.int64), pa.array(edge, pa.binary()), pa.array(after, pa.int64()), join(doc, np.int64), join(row, np.int64), join(at, np.int32), join(n, np.int32)],
                ["node", "edge", "next", "doc_id", "row", "at", "n"],
            )

    return run


def edge_id(edge: bytes) -> int:
    """The first eight bytes of a name, as SQL's conv of its hex digits reads them."""
    return int.from_bytes(edge[:8], "big", signed=True)


def joined(parts: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """(at, n) of the paths that edges (at, n, path, edge) make; a path's edges follow on one
    another, and one that comes again begins the path anew."""
    out, end, last, start = [], None, None, None
    for at, n, path, edge in sorted(parts):
        if path == last and at == end and edge != start:
            out[-1] = (out[-1][0], out[-1][1] + n)
        else:
            out.append((at, n))
            start = edge
        end, last = at + n, path
    return out


def _spelled(span: int):
    """The words at each coordinate: (words, doc_id, row, at, n), words a digest of n windows."""

    def run(batches):
        for b in slices(batches, 200):
            key, doc, row, at, n = [], [], [], [], []
            for d, own, text, parts in zip(*(c.to_pylist() for c in b.columns)):
                w = Words(text)
                spans = joined([(p["at"], p["n"], p["path"], p["id"]) for p in parts if p["path"] is not None])
                spans += [(i, 1) for p in parts if p["path"] is None for i in range(p["at"], p["at"] + p["n"])]
                key += [hashlib.blake2b(w.text(a, a + c + span - 1), digest_size=16).digest() for a, c in spans]
                doc += [d] * len(spans)
                row += [own] * len(spans)
                at += [a for a, _ in spans]
                n += [c for _, c in spans]
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((key, doc, row, at, n), kinds)], ["words", "doc_id", "row", "at", "n"])

    return run


def covered(n: int, spans: list) -> np.ndarray:
    """Which of n words lie in a span (first, last + 1)."""
    step = np.zeros(n + 1, np.int64)
    for a, e in spans:
        step[a] += 1
        step[e] -= 1
    return np.cumsum(step[:-1]) > 0


def paths(met: DataFrame) -> DataFrame:
    """(edge, path) of the edges on compacted paths of two or more; met: id, next of every occurrence of the repeated edges."""
    steps = met.groupBy("id").agg(F.count("*").alias("n"), F.count("next").alias("followed"), F.min("next").alias("next"), F.max("next").alias("other"))
    steps = stage(steps, "steps")
    follower = steps.select(F.col("id").alias("next"), F.col("n").alias("n_next"))
    links = steps.filter("followed = n and next = other and next <> id").join(follower, "next").filter("n = n_next")
    return components(links.select(F.col("id").alias("u"), F.col("next").alias("v"))).select(F.col("node").alias("id"), F.col("root").alias("path"))


def rows_of(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text) of the rows that take part; row tells texts of one doc_id apart."""
    some = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return some.select("doc_id", F.xxhash64("text", "doc_id").alias("row"), "text")


def repeated(docs: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(doc_id, row, spans): for each row with words to remove, arrays of (first, last + 1)."""
    texts = rows_of(docs)
    edges = stage(texts.mapInArrow(tidy(_edges(span, k)), "node long, edge binary, next long, doc_id long, row long, at int, n int"), "edges")
    by_edge = edges.groupBy("node", "edge").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    by_edge = stage(by_edge, "distinct-edges")
    by_node = by_edge.groupBy("node").agg(F.count("*").alias("n_edges"), F.min("first").alias("low"), F.max("last").alias("high")).filter("low < high")
    by_node = stage(by_node.select("node", "n_edges"), "repeated-nodes")
    live = by_edge.join(by_node, "node").filter("n_edges > 1 or first < last")
    live = stage(live.select("node", "edge", "first", (F.col("first") < F.col("last")).alias("twice"), (F.col("n_edges") > 1).alias("branching")), "repeated-edges")
    unstage(by_edge)
    unstage(by_node)
    name = F.conv(F.hex(F.substring("edge", 1, 8)), 16, -10).cast("long")
    met = edges.join(live, ["node", "edge"]).select(name.alias("id"), "next", "doc_id", "row", "at", "n", "twice", (F.col("branching") & (F.col("doc_id") == F.col("first"))).alias("source"))
    met = stage(met, "met")
    unstage(edges)
    unstage(live)

    twice = met.filter("twice")
    on_path = twice.join(paths(twice), "id", "left").select("doc_id", "row", F.struct("at", "n", F.coalesce("path", "id").alias("path"), "id").alias("part"))
    alone = met.filter("source").select("doc_id", "row", F.struct("at", "n", F.lit(None).cast("long").alias("path"), "id").alias("part"))
    parts = on_path.union(alone).groupBy("doc_id", "row").agg(F.collect_set("part").alias("parts"))
    found = texts.join(parts, ["doc_id", "row"]).select("doc_id", "row", "text", "parts")
    found = stage(found.mapInArrow(tidy(_spelled(span)), "words binary, doc_id long, row long, at int, n int"), "spelled")
    unstage(met)
    earliest = found.groupBy("words").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    later = found.join(stage(earliest.select("words", "first"), "repeated-words"), "words").filter("doc_id > first")
    spans = F.struct(F.col("at").alias("first"), (F.col("at") + F.col("n") + span - 1).alias("last"))
    return later.groupBy("doc_id", "row").agg(F.collect_set(spans).alias("spans"))


def remove(docs: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """docs with `text` as the kept words joined by one space, and n_words, n_removed, kept_sha256."""
    found = repeated(docs, span, k).select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), F.col("spans").alias("__spans"))
    kept = [c for c in docs.columns if c not in ("text", "n_words", "n_removed", "kept_sha256")]

    def run(batches):
        for b in slices(batches):
            out = []
            for text, spans in zip(b.column("text").to_pylist(), b.column("__spans").to_pylist()):
                words = (text or "").encode().split()
                stay, removed = b" ".join(words), 0
                if spans:
                    gone = covered(len(words), [(s["first"], s["last"]) for s in spans])
                    stay = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                    removed = int(gone.sum())
                out.append((stay.decode(), len(words), removed, hashlib.sha256(stay).hexdigest()))
            cols = list(zip(*out)) or [[]] * 4
            made = [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + made, [*kept, "text", "n_words", "n_removed", "kept_sha256"])

    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept) + "text string, n_words long, n_removed long, kept_sha256 string"
    own = F.col("doc_id").cast("long")
    whole = docs.select(*kept, "text", own.alias("__id"), F.xxhash64("text", own).alias("__row"))
    return whole.join(found, ["__id", "__row"], "left").select(*kept, "text", "__spans").mapInArrow(tidy(run), schema)


def query(docs: DataFrame) -> DataFrame:
    return remove(docs.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
low AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT win.doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN low USING (h) WHERE first < win.doc_id)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT word.doc_id, count(gone.p) AS n_removed, string_agg(x, ' ' ORDER BY word.p) FILTER (WHERE gone.p IS NULL) AS stay
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(stay, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
