"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a minimal perfect hash over the vocabulary resolves a pre-token that is
itself a vocabulary entry. Tier 2: any other pre-token is merged by a heap of
adjacent pairs over a linked list of its bytes. A bounded memo per Python worker
keeps the ids of pre-tokens already seen by the same query.

The tables are built once on the driver from a rank file and broadcast; their
size is bound by the vocabulary (about 50,000 entries), not by the data.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.llm.tasks import map_arrow

MEMO_ENTRIES = 500_000
MEMO_KEY_CHARS = 256
#: Longer texts are matched piece by piece instead of into one list.
LIST_CHARS = 1 << 20

# Pre-token matching for texts of ASCII and Latin letters only: there the
# Unicode classes of the public pattern are these plain ranges, and the standard
# engine matches them twice as fast. Every other text takes the pattern itself.
_LATIN = "A-Za-zÀ-ÖØ-öø-ʫ"
_OTHER = re.compile(f"[^\t-\r -~{_LATIN[6:]}]")
_FAST = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\s0-9{_LATIN}]+|\s+(?!\S)|\s+")


@functools.cache
def _compiled(pattern: str):
    return regex.compile(pattern)


def pretokens(text: str, pattern: str) -> Iterator[list[str]]:
    """The matches of the public pattern, in order, in lists of bounded length."""
    matcher = _compiled(pattern) if _OTHER.search(text) else _FAST
    if len(text) <= LIST_CHARS:
        yield matcher.findall(text)
    else:
        found = (m.group() for m in matcher.finditer(text))
        while part := list(itertools.islice(found, 1 << 17)):
            yield part


def read_ranks(spark: SparkSession, path: str) -> list[bytes]:
    """Vocabulary entries by rank, from a rank file (base64, rank per line).
    The file is read on the driver, where its path is valid."""
    with open(path, "rb") as f:
        ranks = {int(r): base64.b64decode(w) for w, r in map(bytes.split, f.read().splitlines())}
    return [ranks[i] for i in range(len(ranks))]


class PerfectHash:
    """Minimal perfect hash by hash-and-displace: n keys fill exactly n slots.

    A key's bucket holds a displacement d; its slot is mix(hash, d) mod n.
    Buckets are placed largest first; a bucket of one key names its slot
    directly as -(slot + 1)."""

    MASK = (1 << 64) - 1

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.buckets = n // 4 + 1
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        by_bucket: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            by_bucket.setdefault(h % self.buckets, []).append(i)
        displace, slots = np.zeros(self.buckets, np.int64), np.full(n, -1, np.int64)
        order = sorted(by_bucket.items(), key=lambda kv: -len(kv[1]))
        for bucket, members in order:
            if len(members) == 1:
                break
            d = 1
            while True:
                at = [self._mix(hashes[i], d) % n for i in members]
                if len(set(at)) == len(at) and all(slots[a] < 0 for a in at):
                    break
                d += 1
            displace[bucket] = d
            slots[at] = members
        free = iter(np.flatnonzero(slots < 0).tolist())
        for bucket, members in order:
            if len(members) == 1:
                a = next(free)
                displace[bucket], slots[a] = -a - 1, members[0]
        self.displace, self.slots = displace.tolist(), slots.tolist()

    @classmethod
    def _mix(cls, h: int, d: int) -> int:
        x = ((h ^ (d * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & cls.MASK
        return x ^ (x >> 29)

    def index(self, key: bytes) -> int:
        """The slot's key number; right for keys of the set, any for others."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displace[h % self.buckets]
        return self.slots[-d - 1 if d < 0 else self._mix(h, d) % self.n]


class Vocabulary:
    """Tables of one rank file: entries by rank, ranks by entry for pairs, and the
    perfect hash over the entries for whole pre-tokens."""

    def __init__(self, entries: list[bytes]):
        self.entries, self.hash = entries, PerfectHash(entries)
        self.ranks = {e: i for i, e in enumerate(entries)}

    def rank(self, piece: bytes) -> int | None:
        i = self.hash.index(piece)
        return i if self.entries[i] == piece else None


def merge_bytes(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """Ranks after merging the adjacent pair of lowest rank (leftmost first)
    until no pair is a vocabulary entry. O(n log n) for n bytes."""
    n, get = len(piece), ranks.get
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        right = end[i]
        if not right or right >= n or end[right] != stop:
            continue                    # one of the pair was merged meanwhile
        end[i], end[right] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (left := before[i]) >= 0 and (r := get(piece[left:stop])) is not None:
            heapq.heappush(heap, (r, left, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Memo(dict):
    """pre-token -> its ids as little-endian 32-bit bytes.

    Two generations of bounded size: when the young one is full it becomes the
    old one, whose entries return on use and are else forgotten."""

    def __init__(self, encode):
        self.encode, self.old = encode, {}

    def __missing__(self, token: str) -> bytes:
        if (out := self.old.get(token)) is None:
            ids = self.encode(token)
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(token) <= MEMO_KEY_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[token] = out
        return out


_OF_PROCESS: dict = {}


def of_process(key, query: str, make):
    """``make()``, kept under ``key`` for the later tasks of one query in a Python
    worker. A new query replaces it, so no query profits from an earlier one."""
    if _OF_PROCESS.get(key, ("",))[0] != query:
        _OF_PROCESS[key] = (query, make())
    return _OF_PROCESS[key][1]


def new_query() -> str:
    """A name for one call of an operator, made on the driver."""
    return uuid.uuid4().hex


def encoder(vocab: Vocabulary) -> Memo:
    def encode(token: str) -> list[int]:
        piece = token.encode()
        r = vocab.rank(piece)
        return [r] if r is not None else merge_bytes(vocab.ranks, piece)
    return Memo(encode)


def encode_blocks(text: str | None, memo: Memo, pattern: str) -> Iterator[bytes]:
    """Ids of the text as little-endian 32-bit bytes, in blocks."""
    for part in pretokens(text or "", pattern):
        yield b"".join(map(memo.__getitem__, part))


def decode_ids(ids: bytes, entries: list[bytes]) -> bytes:
    return b"".join(map(entries.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def load_vocabulary(path: str) -> Vocabulary:
    return Vocabulary(read_ranks(None, path))


def encode_documents(docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per input row: id, ids (binary, little-endian unsigned 32-bit).

    Each match of ``pattern`` is encoded by itself, without special tokens.
    Null or empty text: no ids. Repeated rows each get a row; other columns are
    ignored. A narrow map: no shuffle, rows are independent."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocab_path))
    query = new_query()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        _, memo = of_process("bpe", query, lambda: (shared.value, encoder(shared.value)))
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = [b"".join(encode_blocks(t.as_py(), memo, pattern)) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["id", "ids"])

    kind = src.schema["id"].dataType.simpleString()
    return map_arrow(src, run, f"id {kind}, ids binary").select(F.col("id").alias(id_col), "ids")


def decode_documents(encoded: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id, data (binary): the bytes the ids stand for.
    Null ids give null; an id outside the vocabulary is an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(vocab_path))
    src = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches):
        entries = shared.value.entries
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                data = [None if not x.is_valid else decode_ids(x.as_py(), entries) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(data, pa.binary())], names=["id", "data"])

    kind = src.schema["id"].dataType.simpleString()
    return map_arrow(src, run, f"id {kind}, data binary").select(F.col("id").alias(id_col), "data")


def round_trip_digests(docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256.

    Encodes and decodes block by block inside one task, so neither the ids nor
    the decoded bytes of a very long text are held whole. Null text counts as
    empty: 0 tokens and the digests of nothing."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocab_path))
    query = new_query()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def one(text, memo, entries):
        n, ids_hash, data_hash = 0, hashlib.sha256(), hashlib.sha256()
        for block in encode_blocks(text, memo, pattern):
            n += len(block) // 4
            ids_hash.update(block)
            data_hash.update(decode_ids(block, entries))
        return n, ids_hash.hexdigest(), data_hash.hexdigest()

    def run(batches):
        vocab, memo = of_process("bpe", query, lambda: (shared.value, encoder(shared.value)))
        for b in batches:
            n, ids, data = zip(*[one(t.as_py(), memo, vocab.entries) for t in b.column(1)], strict=True) if b.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(data, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = src.schema["id"].dataType.simpleString()
    return (map_arrow(src, run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))
