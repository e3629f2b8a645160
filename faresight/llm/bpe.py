"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pre-tokens are the matches of a pattern.  Inside one, tokens form a linked
list.  Every adjacent pair that can merge waits in the bucket of its merge
rank; a two-level bitmap over ranks says which buckets are in use, so the
lowest rank is found by two find-first-set operations.  The leftmost position
of that bucket merges; entries whose pair has changed meanwhile are stale and
skipped.  The work for a pre-token of n bytes is O(n log n), also for very long
ones, and the merges are exactly those of rank-ordered BPE (lowest rank first,
leftmost among equals).  New pre-tokens of many texts share one queue, as if they
were one long pre-token whose parts never meet, so a rank is looked up once for
all its places.

Encoding runs inside Arrow batches; each Python worker keeps a bounded table of
pre-tokens already encoded, also between tasks.  The vocabulary (under a million bytes) is read on
the driver from a path that the caller gives and broadcast.

Cases: a null or empty text has no ids and decodes to no bytes; every text
decodes to its own UTF-8 bytes; strings of special tokens are ordinary text;
repeated rows and null doc_ids each give a row; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain
from struct import Struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEPT_PRETOKENS = 1_000_000  # about 200 bytes each; half of them those last met
KEPT_LENGTH = 64  # bytes; longer pre-tokens are encoded anew each time
QUEUE_BYTES = 1 << 18  # new pre-tokens that share a queue (a longer one has its own)
TEXT_CHARS = 1 << 20  # texts that are split together
ID = Struct("=i")


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines ``base64 rank`` of a vocabulary file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


class RankQueue:
    """Buckets of positions by rank; the lowest rank in use is found through two levels of bitmaps."""

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}  # positions, the leftmost last unless unsorted
        self.unsorted: set[int] = set()
        self.words: dict[int, int] = {}  # rank // 64 -> bitmap of ranks
        self.summary = 0  # bitmap of words in use

    def fill(self, rank: int, positions: list[int]) -> None:
        """A bucket that is not in use yet; ``positions`` descend."""
        self.buckets[rank] = positions
        word = rank >> 6
        self.words[word] = self.words.get(word, 0) | 1 << (rank & 63)
        self.summary |= 1 << word

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            bucket.append(position)
            self.unsorted.add(rank)
        else:
            self.fill(rank, [position])

    def lowest(self) -> tuple[int, list[int]] | None:
        """(rank, its bucket, from which the leftmost position pops); None if no rank is in use."""
        while self.summary:
            word = (self.summary & -self.summary).bit_length() - 1
            bits = self.words[word]
            rank = word << 6 | (bits & -bits).bit_length() - 1
            bucket = self.buckets[rank]
            if bucket:
                if rank in self.unsorted:
                    bucket.sort(reverse=True)
                    self.unsorted.discard(rank)
                return rank, bucket
            self.words[word] = bits = bits & (bits - 1)  # used up
            if not bits:
                self.summary &= self.summary - 1
        return None


class Codec:
    """Encoder and decoder for one vocabulary and pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())
        self.decimals = pa.array([b"%d," % rank for rank in range(len(tokens))], pa.large_binary())
        self.whole = ranks
        self.byte_rank = [ranks[bytes([i])] for i in range(256)]
        # each token's halves that merge to it, and what it merges to with the token behind and before it
        self.halves: dict[int, dict[int, int]] = {}
        self.behind: dict[int, dict[int, int]] = {}
        self.ahead: dict[int, dict[int, int]] = {}
        for t, r in ranks.items():
            for i in range(1, len(t)):
                x, y = ranks.get(t[:i]), ranks.get(t[i:])
                if x is not None and y is not None:
                    self.halves.setdefault(r, {})[x] = y
                    self.behind.setdefault(x, {})[y] = r
                    self.ahead.setdefault(y, {})[x] = r
        self.byte_pairs = np.full(1 << 16, -1, dtype=np.int64)
        for t, r in ranks.items():
            if len(t) == 2:
                self.byte_pairs[t[0] << 8 | t[1]] = r
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}  # ids as int32
        self.older: dict[str, bytes] = {}  # met before; those met again move to ``known``

    def _queue(self, data: np.ndarray, last: np.ndarray) -> RankQueue:
        """Queue of the pairs of bytes that merge; ``last``: positions that end a pre-token."""
        rank = np.full(len(data), -1, dtype=np.int64)
        rank[:-1] = self.byte_pairs[data[:-1].astype(np.int64) << 8 | data[1:]]
        rank[last] = -1
        places = np.flatnonzero(rank >= 0)[::-1]
        order = np.argsort(rank[places], kind="stable")
        places, ranks = places[order], rank[places[order]]
        cut = np.flatnonzero(np.diff(ranks)) + 1
        queue = RankQueue()
        for part in np.split(places, cut) if len(places) else ():
            queue.fill(int(rank[part[0]]), part.tolist())
        return queue

    def encode_pretokens(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token (none of them empty), as int32.

        All pre-tokens share one queue: their linked lists do not touch, and
        the lowest rank of all is never above the lowest of any one of them.
        """
        flat = b"".join(pieces)
        data = np.frombuffer(flat, dtype=np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        n = len(flat)
        link = np.arange(1, n + 1, dtype=np.int32)
        link[ends - 1] = -1
        after = array("i", link.tobytes())
        link = np.arange(-1, n - 1, dtype=np.int32)
        link[ends[:-1]] = -1
        before = array("i", link.tobytes())
        token = array("i", np.asarray(self.byte_rank, dtype=np.int32)[data].tobytes())
        queue, none = self._queue(data, ends - 1), {}
        push = queue.push
        while (entry := queue.lowest()) is not None:
            rank, bucket = entry
            lower = False
            halves, behind, ahead = self.halves[rank], self.behind.get(rank, none), self.ahead.get(rank, none)
            while bucket and not lower:
                i = bucket.pop()
                j = after[i]
                if j < 0 or halves.get(token[i]) != token[j]:
                    continue  # stale: one of the two has merged otherwise
                token[i] = rank
                token[j] = -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    if (new := behind.get(token[k])) is not None:
                        push(new, i)
                        lower = new < rank
                if (h := before[i]) >= 0 and (new := ahead.get(token[h])) is not None:
                    push(new, h)
                    lower = lower or new < rank
        ids = np.frombuffer(token, dtype=np.int32)
        left = ids >= 0
        bounds = (ids.itemsize * np.cumsum(left)[ends - 1]).tolist()
        raw = ids[left].tobytes()
        return [raw[a:b] for a, b in zip([0, *bounds[:-1]], bounds)]

    def _learn(self, pretokens: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens not met before."""
        learnt: dict[str, bytes] = {}
        group: list[str] = []
        raw: list[bytes] = []
        size = 0
        for p in chain(pretokens, (None,)):
            if p is None or size > QUEUE_BYTES:
                for q, r, ids in zip(group, raw, self.encode_pretokens(raw) if raw else ()):
                    learnt[q] = ids
                    if len(r) <= KEPT_LENGTH:
                        self.known[q] = ids
                group, raw, size = [], [], 0
            if p is not None:
                b = p.encode("utf-8")
                whole = self.whole.get(b)
                if whole is not None:
                    learnt[p] = self.known[p] = ID.pack(whole)
                else:
                    group.append(p)
                    raw.append(b)
                    size += len(b)
        return learnt

    def _ids(self, pretokens: set[str]) -> dict[str, bytes]:
        """Ids of each of these pre-tokens."""
        if 2 * (len(self.known) + len(pretokens)) > KEPT_PRETOKENS:
            self.known, self.older = {}, self.known
        ids = dict(zip(pretokens, map(self.known.get, pretokens)))
        new = [p for p, x in ids.items() if x is None]
        if new and self.older:
            again = {p: x for p, x in zip(new, map(self.older.get, new)) if x is not None}
            self.known.update(again)
            ids.update(again)
            new = [p for p in new if p not in again]
        if new:
            ids.update(self._learn(new))
        return ids

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (int32), and where each text's begin and the last one's end."""
        split = [self.find(t) for t in texts]
        ids = self._ids(set(chain.from_iterable(split)))
        raw = [b"".join(map(ids.__getitem__, pretokens)) for pretokens in split]
        bounds = np.cumsum([0, *map(len, raw)]) // ID.size
        return np.frombuffer(b"".join(raw), dtype=np.int32), bounds

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        flat, bounds = self.encode_flat(texts)
        return [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        return self.encode_batch([text])[0]

    def decode_flat(self, ids: np.ndarray, bounds: np.ndarray) -> list[memoryview]:
        """Bytes of each of several sequences of ids, as ``encode_flat`` gives them."""
        return _joined(self.tokens, ids, bounds)

    def decode(self, ids) -> bytes:
        """Bytes of a sequence of ids."""
        return bytes(self.decode_flat(np.asarray(ids, dtype=np.int32), np.array([0, len(ids)]))[0])

    def listed(self, ids: np.ndarray, bounds: np.ndarray) -> list[memoryview]:
        """Decimal ids of each sequence, joined by commas."""
        return [m[:-1] for m in _joined(self.decimals, ids, bounds)]


def _joined(values: pa.Array, at: np.ndarray, bounds: np.ndarray) -> list[memoryview]:
    """The values at each sequence of places, joined."""
    taken = values.take(pa.array(at, pa.int32()))
    if taken.null_count:
        raise KeyError("an id that the vocabulary lacks")
    if not len(at):
        return [memoryview(b"")] * (len(bounds) - 1)
    ends = np.frombuffer(taken.buffers()[1], dtype=np.int64)[bounds].tolist()
    data = memoryview(taken.buffers()[2])
    return [data[a:b] for a, b in zip(ends, ends[1:])]


_CODECS: dict[tuple[bytes, str], Codec] = {}


def worker_codec(vocabulary: bytes, pattern: str) -> Codec:
    """The codec of this Python worker, with the pre-tokens that its earlier tasks learnt (one vocabulary is kept)."""
    key = hashlib.sha256(vocabulary).digest(), pattern
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(parse_ranks(vocabulary), pattern)
    return _CODECS[key]


def text_groups(column: pa.Array) -> Iterator[list[str]]:
    """Texts in groups of bounded size (a longer one has its own)."""
    group, size = [], 0
    for t in column:
        text = t.as_py()
        if group and size + len(text) > TEXT_CHARS:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def read_ranks(spark: SparkSession, path: str):
    """The vocabulary file's bytes, broadcast (its size is that of one vocabulary)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_documents(spark: SparkSession, docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row."""
    raw = read_ranks(spark, vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(raw.value, pattern)
        for batch in batches:
            begin = 0
            for texts in text_groups(batch.column("_text")):
                ids, bounds = codec.encode_flat(texts)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, len(texts)), lists], ["doc_id", "ids"])
                begin += len(texts)

    return _texts(docs, doc_id, text).mapInArrow(rows, "doc_id long, ids array<int>")


def decode_documents(spark: SparkSession, encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``bytes`` (binary) of every row of ``doc_id, ids``; null ids decode to no bytes."""
    raw = read_ranks(spark, vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(raw.value, pattern)
        for batch in batches:
            made = [codec.decode(x.as_py() or ()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, bytes binary")


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Encode every text and decode its ids: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    raw = read_ranks(spark, vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(raw.value, pattern)
        for batch in batches:
            counts, ids_digest, decoded_digest = [], [], []
            for texts in text_groups(batch.column("_text")):
                ids, bounds = codec.encode_flat(texts)
                counts += np.diff(bounds).tolist()
                ids_digest += [hashlib.sha256(m).hexdigest() for m in codec.listed(ids, bounds)]
                decoded_digest += [hashlib.sha256(m).hexdigest() for m in codec.decode_flat(ids, bounds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_digest, pa.string()),
                 pa.array(decoded_digest, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs, doc_id, text).mapInArrow(
        rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
