"""Cost-balanced packing of tokenised documents into fixed-length sequences.

A piece of n tokens costs n * (1 + n / QUADRATIC) (linear work plus attention
over itself). Pieces go in descending length to the sequence of lowest cost that
still has room for them; if none has, the lowest-cost sequence with any room
takes what fits and the rest is assigned again. Documents may be cut freely, so
the sequences of a bucket are opened to hold exactly its tokens: full ones, and
power-of-two ones for the remainder, so nothing is padded.

Tokenising and packing happen in one narrow stage. A bucket is a bounded number
of tokens of one input partition; no text and no ids are shuffled.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.llm.bpe import Memo, encode_blocks, new_query, of_process
from clickspark.llm.tasks import map_arrow

MAX_TOKENS = 2048
END_ID = 1
BUCKET_TOKENS = 1 << 21
#: Piece length at which quadratic cost equals linear cost.
QUADRATIC = 1024

PIECES = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long")


def capacities(total: int, max_tokens: int = MAX_TOKENS) -> np.ndarray:
    """Sequence lengths that hold ``total`` tokens exactly: full sequences, then
    the powers of two that make up the remainder."""
    full, rest = divmod(total, max_tokens)
    return np.array([max_tokens] * full + [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1], np.int64)


def assign(lengths: list[int], max_tokens: int = MAX_TOKENS, quadratic: int = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these
    lengths. Every token lies in one piece; offsets in a sequence are gapless;
    equal lengths keep their order, equal costs take the lowest sequence."""
    room = capacities(sum(lengths), max_tokens)
    cost, filled, out = np.zeros(len(room)), np.zeros(len(room), np.int64), []
    whole = 0
    rest = []                               # full-length pieces fill a sequence each
    for d, n in enumerate(lengths):
        for start in range(0, n - n % max_tokens, max_tokens):
            out.append((d, start, max_tokens, whole, 0))
            room[whole] = 0
            whole += 1
        if n % max_tokens:
            rest.append((n % max_tokens, d))
    rest.sort(key=lambda x: (-x[0], x[1]))
    for n, d in rest:
        start = lengths[d] - n
        while n:
            fits = room >= n
            q = int(np.where(fits if fits.any() else room > 0, cost, np.inf).argmin())
            take = min(n, int(room[q]))
            out.append((d, start, take, q, int(filled[q])))
            cost[q] += take * (1 + take / quadratic)
            filled[q] += take
            room[q] -= take
            start, n = start + take, n - take
    return out


@functools.cache
def _tokenizer(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"], os.environ["RAYON_NUM_THREADS"] = "false", "1"
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(definition)
    t.encode_special_tokens = True          # their strings in a text are ordinary text
    return t


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable
    bytes stand for themselves, the others for the letters from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = itertools.count(256)
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


def _encoder(definition: str) -> Memo:
    """Ids of one pre-token by the tokenizer's model. The tokenizer would only
    split a pre-token again (into itself) and note its offsets."""
    model, letters = _tokenizer(definition).model, _byte_letters()
    return Memo(lambda pretoken: [t.id for t in model.tokenize(pretoken.encode().decode("latin-1").translate(letters))])


def pack_documents(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   max_tokens: int = MAX_TOKENS, end_id: int = END_ID, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are its text's, then ``end_id``; null or empty text gives
    that id alone. Every input row is packed, repeated rows and null ids too.
    Other columns are ignored. ``pattern`` must be the split that the tokenizer
    itself makes, and the tokenizer byte-level without a normalizer; each match is
    encoded by the tokenizer's model and kept in a bounded memo. Sequences are ``max_tokens`` long or a power of two, without padding;
    ``max_tokens`` must be a power of two. Sequence ids are unique over the
    result: partition number * 2^32 + count.

    A text whose ids alone exceed a bucket is a bucket of its own. Memory in a
    task: the ids of one bucket.
    """
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    parts = json.loads(definition)
    split = parts["pre_tokenizer"] or {}
    if parts["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"]:
        raise ValueError("the tokenizer must be byte-level, without normalizer and prefix space")
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    query = new_query()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    end = np.array([end_id], "<u4").tobytes()
    kind = src.schema["id"].dataType
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = of_process("packing", query, lambda: _encoder(shared.value))
        first = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        tokens, arrow_id = 0, pa.int64()

        def packed() -> pa.RecordBatch:
            lengths = [len(x[1]) // 4 for x in held]
            rows = assign(lengths, max_tokens)
            cols = [[held[d][0] for d, *_ in rows], [s for _, s, *_ in rows], [n for _, _, n, *_ in rows],
                    [zlib.crc32(memoryview(held[d][1])[4 * s:4 * (s + n)]) for d, s, n, *_ in rows],
                    [lengths[d] for d, *_ in rows], [first + q for *_, q, _ in rows], [o for *_, o in rows]]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], arrow_id), *[pa.array(c, pa.int64()) for c in cols[1:]]], names=names)

        for b in batches:
            arrow_id = b.column(0).type
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                held.append((i, b"".join([*encode_blocks(t.as_py(), memo, pattern), end])))
                tokens += len(held[-1][1]) // 4
                if tokens >= bucket_tokens:
                    yield packed()
                    first += len(capacities(tokens, max_tokens))
                    held, tokens = [], 0
        if held:
            yield packed()

    return map_arrow(src, run, f"id {kind.simpleString()}, {PIECES}").withColumnRenamed("id", id_col)
