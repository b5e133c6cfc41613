"""Exact top-k by inner product over a bit-sliced index.

Components become integers, floor(256 x).  A block of rows is indexed by slices:
for each component, the rows' most significant bits, one bitmap over the rows for
each bit.  For a query, the slices of all components are weighted by the bits of the
query and added with carry-save bitmap adders, which leaves the bit slices of an
approximate score.  Rows are then selected from the most significant slice downward:
the k best, and with them every row within the error that the dropped low bits can
make.  These boundary rows are resolved by the exact integer product.

Every row is indexed and every query meets every block; nothing is sampled.  Blocks
have at most BLOCK rows and query blocks at most QUERIES, so no task holds more than
one of each.

Defined results: null vectors and vectors with null or non-finite components take no
part; neither do rows without a vec_id; vectors of another length than a query's are
no candidates of it; rows that repeat a vec_id are candidates each on its own, but
never of a query of that id; scores are exact while they fit 64 bits; ties go to the smaller vec_id; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import tidy

BLOCK, QUERIES, GROUP, SLICES = 16384, 512, 64, 6
BLOB = "dim int, ids binary, data binary"


def quantise(vectors) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of the vectors that take part, and their integers."""
    at, rows = [], []
    for i, v in enumerate(vectors):
        if v is None or None in v:
            continue
        x = np.floor(256.0 * np.asarray(v, dtype=np.float64))
        if len(x) and np.isfinite(x).all():
            at.append(i)
            rows.append(x.astype(np.int64))
    return np.array(at, dtype=np.int64), rows


def _narrow(data: np.ndarray) -> np.ndarray:
    fits = np.iinfo(np.int16)
    return data.astype(np.int16) if data.min() >= fits.min and data.max() <= fits.max else data


def _matrix(data: bytes, ids: bytes, dim: int) -> np.ndarray:
    wide = len(data) == len(ids) * dim
    return np.frombuffer(data, np.int64 if wide else np.int16).reshape(-1, dim).astype(np.int64)


def _blobs(size: int):
    def pack(batches):
        held: dict[int, list] = {}

        def flush(dim):
            ids, rows = zip(*held.pop(dim))
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([_narrow(np.stack(rows)).tobytes()], pa.binary())], ["dim", "ids", "data"])

        for b in batches:
            ids = b.column(0).to_pylist()
            at, rows = quantise(b.column(1).to_pylist())
            for i, row in zip(at.tolist(), rows):
                if ids[i] is None:
                    continue
                mine = held.setdefault(len(row), [])
                mine.append((ids[i], row))
                if len(mine) == size:
                    yield flush(len(row))
        for dim in list(held):
            yield flush(dim)

    return pack


class SlicedIndex:
    """Bitmaps over the rows of a block: slices[b][j] has bit (top - b) of component j, offset so that none is negative."""

    def __init__(self, data: np.ndarray, keep: int = SLICES):
        self.data = data
        self.low = data.min(axis=0)
        above = (data - self.low).astype(np.uint64)
        self.bits = max(1, int(above.max()).bit_length())
        self.dropped = max(0, self.bits - keep)
        kept = self.bits - self.dropped
        n = len(data)
        words = -(-n // 64)
        self.slices = np.zeros((kept, data.shape[1], words), dtype=np.uint64)
        for b in range(kept):
            plane = ((above >> np.uint64(self.dropped + b)) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(plane, axis=0, bitorder="little")
            padded = np.zeros((words * 8, data.shape[1]), dtype=np.uint8)
            padded[: len(packed)] = packed
            self.slices[b] = np.ascontiguousarray(padded.T).view(np.uint64)
        valid = np.zeros(words * 8, dtype=np.uint8)
        valid[: -(-n // 8)] = np.packbits(np.ones(n, np.uint8), bitorder="little")
        self.valid = valid.view(np.uint64)

    def _sum(self, q: np.ndarray) -> list[np.ndarray]:
        """Bit slices, lowest first, of the approximate score above its least possible value.

        A negative weight takes the complement of a component's bits, which differs
        by a constant of the query alone."""
        columns: dict[int, np.ndarray] = {}
        size = np.abs(q)
        for c in range(int(size.max()).bit_length() if len(size) else 0):
            on = np.flatnonzero((size >> c) & 1)
            if not len(on):
                continue
            flip = np.where(q[on] < 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, None]
            for b in range(len(self.slices)):
                part = self.slices[b][on] ^ flip
                columns[b + c] = np.concatenate([columns[b + c], part]) if b + c in columns else part
        out, w = [], 0
        while columns:
            have = columns.pop(w, None)
            while have is not None and len(have) > 1:  # full adders: three bitmaps to a sum and a carry
                third = len(have) // 3
                if third:
                    x, y, z = have[:third], have[third : 2 * third], have[2 * third : 3 * third]
                    u = x ^ y
                    total, carry, rest = u ^ z, (x & y) | (u & z), have[3 * third :]
                else:
                    x, y = have[:1], have[1:2]
                    total, carry, rest = x ^ y, x & y, have[2:]
                have = np.concatenate([total, rest]) if len(rest) else total
                columns[w + 1] = np.concatenate([columns[w + 1], carry]) if w + 1 in columns else carry
            out.append(have[0] if have is not None else np.zeros(self.slices.shape[2], np.uint64))
            w += 1
        return out

    def top(self, q: np.ndarray, k: int, allowed: np.ndarray | None = None) -> np.ndarray:
        """Rows that hold the k best by exact score, ties at the boundary included."""
        valid = self.valid if allowed is None else self.valid & allowed
        if int(np.bitwise_count(valid).sum()) <= k:
            return self._rows(valid)
        slices = self._sum(q)
        sure, tied, floor = np.zeros_like(valid), valid, 0
        for w in range(len(slices) - 1, -1, -1):  # the k-th best approximate score, bit by bit
            ones = tied & slices[w]
            if int(np.bitwise_count(sure | ones).sum()) >= k:
                tied, floor = ones, floor | (1 << w)
            else:
                sure, tied = sure | ones, tied & ~slices[w]
        # dropped bits add 0 to (2^dropped - 1) for each unit of weight, so a row this far below may still be among the best
        slack = int(np.abs(q).sum()) if self.dropped else 0
        least = floor - slack
        if least <= 0:
            return self._rows(valid)
        over, equal = np.zeros_like(valid), valid
        for w in range(max(len(slices), least.bit_length()) - 1, -1, -1):  # approximate score >= least
            s = slices[w] if w < len(slices) else np.zeros_like(valid)
            if least >> w & 1:
                equal = equal & s
            else:
                over, equal = over | (equal & s), equal & ~s
        return self._rows(over | equal)

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: len(self.data)])


def best(index: SlicedIndex, ids: np.ndarray, q_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(vec_id, score) of the k best rows other than the query's own."""
    own = np.flatnonzero(ids == q_id)
    allowed = None
    if len(own):
        allowed = np.full(len(index.valid), 0xFFFFFFFFFFFFFFFF, np.uint64)
        for i in own.tolist():
            allowed[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
    rows = index.top(q, k, allowed)
    scores = index.data[rows] @ q
    order = np.lexsort((ids[rows], -scores))[:k]
    return [(int(ids[rows[i]]), int(scores[i])) for i in order]


def _search(k: int):
    def run(batches):
        seen, index = None, None
        for b in batches:
            for dim, q_ids, q_data, ids, data in zip(*(c.to_pylist() for c in b.columns)):
                if seen != ids:
                    seen, index = ids, SlicedIndex(_matrix(data, ids, dim))
                row_ids, out = np.frombuffer(ids, np.int64), []
                for q_id, q in zip(np.frombuffer(q_ids, np.int64).tolist(), _matrix(q_data, q_ids, dim)):
                    out += [(q_id, v, s) for v, s in best(index, row_ids, q_id, q, k)]
                cols = list(zip(*out)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, lanes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) over frames of (vec_id, embedding).

    Row blocks are dealt over lanes and query blocks over groups of some GROUP blocks; the
    two meet once for each lane and group, an equi-join of a stated query set with all rows,
    block by block.  What a task holds of the queries is a group, however many there are."""
    lanes = lanes or int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.select("vec_id", "embedding").mapInArrow(tidy(_blobs(BLOCK)), BLOB)
    asked = queries.select("vec_id", "embedding")
    blocks = 1 + asked.count() // QUERIES
    groups = -(-blocks // GROUP)
    asked = asked.repartition(blocks).mapInArrow(tidy(_blobs(QUERIES)), BLOB)
    rows = rows.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
    asked = asked.select("dim", "group", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    met = rows.join(asked.hint("shuffle_hash"), ["lane", "group", "dim"]).select("dim", "q_ids", "q_data", "ids", "data")
    found = met.mapInArrow(tidy(_search(k)), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, embeddings.filter("vec_id % 50 = 0"), 5)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
