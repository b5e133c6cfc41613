"""Best-fit packing of tokenised documents by minimum bin slack.

Documents become pieces of at most `size` tokens.  Which lengths go together depends
on the histogram of lengths alone, which has at most `size` entries at any scale: for
each bin the longest length left is taken, and a subset-sum dynamic program over
bitsets finds the lengths that fill the bin best.  That combination is taken as often
as the counts allow, then its lengths are removed.  The resulting table of slots is
joined with the pieces, each of which knows its rank among those of its length.

Defined results: a null or empty text is its end mark alone, one piece of one token;
rows that repeat a doc_id are packed row by row; rows without a doc_id are packed too;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from codecs import charmap_decode
from functools import cache
from operator import attrgetter
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, stage, tidy

SIZE, END = 2048, 0
#: A length is ranked in parts of PART pieces; beyond PARTS such parts in all, in larger ones.
PART, PARTS = 1 << 8, 1 << 13
#: Entries of a generation of the encoder's memory, and the longest one in bytes or letters.
KEEP, LONG = 200_000, 64
#: The parts that the tokenizer's own pattern tells apart.
PARTED = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
#: The same for small letters up to U+024F, where a set says what the properties do, in less time.
_LETTERS, _NUMBERS, _SPACE = "a-zªµºß-öø-\u024f", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
PARTED_LATIN = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBERS}]|[^{_SPACE}{_LETTERS}{_NUMBERS}]+")
PARTED_ASCII = re.compile(r"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t-\r a-z0-9]+")
BEYOND = re.compile("[^\0-\u024f]")
#: The letters that stand for bytes in a byte-level model: printable ones of Latin-1 for themselves, the others from U+0100 on.
_OTHERS = [*range(33), *range(127, 161), 173]
BYTES = "".join(chr(256 + _OTHERS.index(b) if b in _OTHERS else b) for b in range(256))
ID = attrgetter("id")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Recent(dict):
    """key -> learn(key), kept for what was looked up last: two generations of at most `keep` entries.  When
    the younger one is full, the older one goes with all that was not asked for again."""

    def __init__(self, keep: int, learn):
        self.keep, self.learn, self.old = keep, learn, {}

    def __missing__(self, key: str) -> bytes:
        if (found := self.old.get(key)) is None:
            found = self.learn(key)
        if len(self) >= self.keep:
            self.old = dict(self)
            self.clear()
        if len(key) <= LONG:
            self[key] = found
        return found


class Encoder:
    """text -> its ids as little-endian unsigned 32-bit bytes.

    The tokenizer normalises and lower-cases, parts a text by a pattern and encodes each
    part by itself.  So a text is parted here, each distinct part is encoded once, by the
    tokenizer's model alone up to U+024F, and looked up after that.
    What is kept is bounded at any vocabulary: the last 2 * KEEP parts, of at most LONG
    characters.  A text that NFC changes, or that holds a special token's string, goes to
    the tokenizer whole."""

    def __init__(self, path: str):
        self.tokenizer, self.held = _tokenizer(path), Recent(KEEP, self._learn)
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model if _by_bytes(self.tokenizer) else None
        self.packed = _bytes_of_each(path).__getitem__

    def __call__(self, text: str) -> bytes:
        ascii = text.isascii()
        low = text.lower() if ascii else text.replace("\u03a3", "\u03c3").lower()  # sigma by itself has one small form
        plain = ascii or is_normalized("NFC", text) and is_normalized("NFC", low)
        if not plain or any(t in low for t in self.special):
            return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parted = PARTED_ASCII if ascii else PARTED if BEYOND.search(low) else PARTED_LATIN
        return b"".join(map(self.held.__getitem__, parted.findall(low)))

    def _learn(self, part: str) -> bytes:
        if self.model is None or not part.isascii() and BEYOND.search(part):
            return _bytes(self.tokenizer.encode(part, add_special_tokens=False).ids)
        letters = part if part.isascii() and part.isprintable() else charmap_decode(part.encode(), "strict", BYTES)[0]
        return b"".join(map(self.packed, map(ID, self.model.tokenize(letters))))


def _bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


@cache
def _bytes_of_each(path: str) -> list[bytes]:
    """Of every id of the vocabulary."""
    ids = _bytes([*range(1 + max(_tokenizer(path).get_vocab().values()))])
    return [ids[at : at + 4] for at in range(0, len(ids), 4)]


def _by_bytes(tokenizer) -> bool:
    """Whether a part's ids are those of its UTF-8 bytes, each written as a letter, by the model alone."""
    from tokenizers.models import BPE

    if tokenizer.pre_tokenizer is None or not isinstance(tokenizer.model, BPE) or tokenizer.model.dropout:
        return False
    state = json.loads(tokenizer.pre_tokenizer.__getstate__())
    *_, last = state.get("pretokenizers", [state])
    return last["type"] == "ByteLevel" and not last["add_prefix_space"] and not last["use_regex"]


@cache
def _tokenizer(path: str):
    """Read once in a worker; what is learnt beside it goes with the task."""
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return Tokenizer.from_file(path)


def pieces(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the documents' ids, cut where they are longer than size."""
    path = tokenizer or default_tokenizer()
    end = END.to_bytes(4, "little")

    def run(batches):
        encode = Encoder(path)
        for b in slices(batches):
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = encode(text or "") + end
                for n, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    out.append((doc, n, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*out)) or [[]] * 5
            types = [b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(tidy(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def fullest(room: int, left: dict[int, int]) -> list[tuple[int, int]]:
    """(length, times) of a combination that fills `room` best, from lengths with counts.

    A bitset holds the sums that the lengths so far can make; each length enters with
    its count in powers of two, and the steps are walked back from the best sum."""
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for n in sorted((x for x in left if x <= room), reverse=True):
        most, take = min(left[n], room // n), 1
        while most:
            take = min(take, most)
            steps.append((n, take, reach))
            reach |= (reach << (n * take)) & full
            most, take = most - take, take * 2
        if reach >> room & 1:
            break
    best, out = reach.bit_length() - 1, {}
    for n, times, before in reversed(steps):
        if not before >> best & 1:
            best -= n * times
            out[n] = out.get(n, 0) + times
    return list(out.items())


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first, last, times, offset, sequence): ranks first to last - 1 of a length go
    `times` to a sequence, from `offset` of sequence number `sequence` on."""
    left, used, slots, sequence = dict(counts), dict.fromkeys(counts, 0), [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        rest = fullest(size - longest, {n: c for n, c in left.items() if c})
        left[longest] += 1
        combination = {longest: 1}
        for n, times in rest:
            combination[n] = combination.get(n, 0) + times
        bins, offset = min(left[n] // times for n, times in combination.items()), 0
        for n, times in sorted(combination.items(), reverse=True):
            slots.append((n, used[n], used[n] + bins * times, times, offset, sequence))
            used[n] += bins * times
            offset += n * times
            left[n] -= bins * times
            if not left[n]:
                del left[n]
        sequence += bins
    return slots


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE) -> DataFrame:
    """pieces with sequence_id and offset.

    Ranks within a length are taken in parts of some PART pieces, with the parts' counts
    before them, so a length that a third of the pieces share is no single task's.  What is
    broadcast has a bound: the slots follow from the histogram of at most `size` lengths, and
    lengths of several parts have at most 2 * PARTS parts together."""
    spark: SparkSession = docs.sparkSession
    cut = stage(pieces(docs, tokenizer, size), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most size rows
    part = max(PART, sum(histogram.values()) // PARTS)
    slots: dict[int, list] = {}
    for n, *slot in plan(histogram, size):
        slots.setdefault(n, []).append(tuple(slot))
    lengths = [(n, -(-c // part), slots[n]) for n, c in histogram.items()]
    lengths = F.broadcast(spark.createDataFrame(lengths, "length long, parts int, slots array<struct<first:long,last:long,times:long,base:long,sequence:long>>"))
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("parts")).cast("int")
    salted = cut.join(lengths, "length").withColumn("salt", salt)
    counts = salted.filter("parts > 1").groupBy("length", "salt").count()  # at most 2 * PARTS rows
    upto = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "salt", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cut.join(lengths.select("length", "parts"), "length").withColumn("salt", salt).withColumn("own", F.row_number().over(order) - 1)
    ranked = ranked.join(F.broadcast(before), ["length", "salt"], "left").withColumn("rank", F.col("own") + F.coalesce("before", F.lit(0)))
    found = F.get(F.filter("slots", lambda s: (s["first"] <= F.col("rank")) & (F.col("rank") < s["last"])), F.lit(0))
    placed = ranked.join(lengths.select("length", "slots"), "length").withColumn("slot", found)
    r, t = F.col("rank") - F.col("slot.first"), F.col("slot.times")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("slot.sequence") + F.floor(r / t)).cast("long").alias("sequence_id"),
        (F.col("slot.base") + (r % t) * F.col("length")).cast("long").alias("offset"),
    )


def query(docs: DataFrame) -> DataFrame:
    return pack(docs)
