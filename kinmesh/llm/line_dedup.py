"""Line deduplication over a whole corpus.

Lines are normalised and hashed (128 bits), the distinct documents of each hash
are counted, and lines whose key is in `min_docs` documents or more are dropped
everywhere; what stays is reassembled by position.

Defined results: a null or empty text is one empty line; an empty key never
counts, so blank lines stay; rows that repeat a doc_id are one document for the
count and each keep their own row; rows without a doc_id are no document for the
count and keep all their lines; an empty table gives no rows; further columns are
carried along untouched.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, small, stage, tidy

BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """Stripped of ASCII white space, A-Z lower-cased."""
    return line.strip(BLANK).lower()


def _hashed(line: bytes) -> bytes | None:
    key = line_key(line)
    return xxhash.xxh3_128_digest(key) if key else None


def _keys_of(batches):
    """One row for each document and distinct key."""
    for b in slices(batches):
        ids, keys = [], []
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if doc is None or not text:
                continue
            own = {_hashed(x) for x in text.encode().split(b"\n")}
            own.discard(None)
            keys += own
            ids += [doc] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["line_key", "doc_id"])


def _reassemble(batches):
    for b in slices(batches):
        text, dropped = b.column("text").to_pylist(), b.column("__drop").to_pylist()
        kept_text, before, gone, digest = [], [], [], []
        for t, d in zip(text, dropped):
            lines = (t or "").encode().split(b"\n")
            if d:
                d = set(d)
                kept = [x for x in lines if _hashed(x) not in d]
            else:
                kept = lines
            joined = b"\n".join(kept)
            kept_text.append(joined.decode())
            before.append(len(lines))
            gone.append(len(lines) - len(kept))
            digest.append(hashlib.sha256(joined).hexdigest())
        keep = [n for n in b.schema.names if n not in ("text", "__drop")]
        yield pa.RecordBatch.from_arrays(
            [b.column(n) for n in keep] + [pa.array(kept_text, pa.string()), pa.array(before, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())],
            [*keep, "text", "n_lines", "n_dropped", "kept_sha256"],
        )


def frequent_lines(docs: DataFrame, min_docs: int):
    """(pairs of key and document, staged keys in at least min_docs documents)."""
    pairs = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(_keys_of), "line_key binary, doc_id long")
    pairs = stage(pairs, "line-keys")
    counted = pairs.distinct().groupBy("line_key").count()
    return pairs, stage(counted.filter(F.col("count") >= min_docs).select("line_key"), "line-frequent")


def dedup_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """docs with `text` rewritten, and n_lines, n_dropped, kept_sha256.

    The dropped keys of each document meet its text in one join on doc_id; a list
    is at most as long as the document has lines.  A hot key is no hot task: the
    frequent keys are broadcast below a checked count, and beyond it the join on
    the key has a bare exchange on both sides, which Spark splits.
    """
    pairs, frequent = frequent_lines(docs, min_docs)
    lost = pairs.join(small(frequent), "line_key").groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_set("line_key").alias("__drop"))
    kept = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped", "kept_sha256")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept) + ", text string, n_lines long, n_dropped long, kept_sha256 string"
    joined = docs.select(*kept, "text").join(lost, docs["doc_id"].cast("long") == F.col("__doc"), "left").drop("__doc")
    return joined.mapInArrow(tidy(_reassemble), schema)


def query(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text"), min_docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, 1 + len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
often AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE often.k IS NOT NULL) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE often.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often ON keyed.k = often.k
GROUP BY doc_id
"""
