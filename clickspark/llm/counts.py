"""Unigram token counts by dynamic programming over a shared trie.

A pre-token is a white-space word with the word mark in front. Its token count
is that of its best segmentation under a unigram model. The distinct pre-tokens
of a batch are walked in sorted order, which is a depth-first walk of their
trie: the forward scores of a prefix stand on a stack and are computed once for
all pre-tokens that share it; at a terminal the count is stored.

Pieces and their order come from a public vocabulary; the score of a piece is
the logarithm of a Zipf probability by its rank there. A character outside the
vocabulary costs one byte piece per UTF-8 byte.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.llm.bpe import new_query, of_process
from clickspark.llm.tasks import map_arrow
from clickspark.llm.text import word_blocks

MARK = "▁"
MEMO_ENTRIES = 1_000_000
MEMO_KEY_CHARS = 256


class Unigram:
    """Scores by piece, the same with the ends of pieces, the score of a byte."""

    def __init__(self, pieces: Iterable[str]):
        pieces = list(pieces)
        norm = math.log(sum(1 / (r + 2) for r in range(len(pieces) + 1)))
        self.scores = {p: -math.log(r + 2) - norm for r, p in enumerate(pieces)}
        # every end of a piece is a key, so a walk back from a position stops where
        # no piece goes on; only whole pieces have a score
        self.ends: dict[str, float | None] = {p[i:]: None for p in pieces for i in range(1, len(p))}
        self.ends.update(self.scores)
        self.byte = -math.log(len(pieces) + 2) - norm

    def counts(self, pretokens: Iterable[str]) -> dict[str, tuple[int, float]]:
        """(tokens, score) of the best segmentation of each distinct pre-token:
        highest score, then fewest tokens."""
        get, out, last = self.ends.get, {}, ""
        best: list[tuple[float, int]] = [(0.0, 0)]      # by prefix length: score, -tokens
        for t in sorted(set(pretokens)):
            keep, most = 0, min(len(t), len(last))
            while keep < most and t[keep] == last[keep]:
                keep += 1
            del best[keep + 1:]
            for i in range(keep + 1, len(t) + 1):
                n = len(t[i - 1].encode())
                s, k = best[i - 1]
                top = (s + n * self.byte, k - n)
                for j in range(i - 1, -1, -1):
                    if (v := get(t[j:i], 0)) == 0:      # scores are below 0
                        break
                    if v is not None:
                        s, k = best[j]
                        if (x := (s + v, k - 1)) > top:
                            top = x
                best.append(top)
            out[t], last = (-best[-1][1], best[-1][0]), t
        return out


@functools.cache
def load_unigram(path: str) -> Unigram:
    """Pieces of a sentencepiece model in the order of their ids, without its
    control, unknown and byte entries."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return Unigram(m.id_to_piece(i) for i in range(m.get_piece_size())
                   if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i)))


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_pretokens, n_tokens (long).

    Null, empty or blank text: 0 and 0. Repeated rows each get a row; other
    columns are ignored. A narrow map without shuffle: each Python worker keeps
    the counts of distinct pre-tokens in a bounded memo while the query runs, and only those not yet known go
    through the trie. A very long text is taken in blocks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_unigram(model_path))
    query = new_query()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memo = of_process("counts", query, lambda: (shared.value, {}))

        def settle(pending: list[tuple[int, Counter]], words: list[int], tokens: list[int]) -> None:
            new = {w for _, c in pending for w in c if w not in memo}
            found = model.counts(MARK + w.decode() for w in new)
            now = {w: found[MARK + w.decode()][0] for w in new}
            for d, c in pending:
                words[d] += sum(c.values())
                tokens[d] += sum(k * (now[w] if w in now else memo[w]) for w, k in c.items())
            if len(memo) + len(now) > MEMO_ENTRIES:
                memo.clear()
            memo.update((w, n) for w, n in now.items() if len(w) <= MEMO_KEY_CHARS)
            pending.clear()

        for b in batches:
            words, tokens = [0] * b.num_rows, [0] * b.num_rows
            pending, held = [], 0
            for d, t in enumerate(b.column(1)):
                for block in word_blocks((t.as_py() or "").encode()):
                    pending.append((d, Counter(block)))
                    held += len(pending[-1][1])
                    if held > 200_000:
                        settle(pending, words, tokens)
                        held = 0
            settle(pending, words, tokens)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=["id", "n_pretokens", "n_tokens"])

    kind = src.schema["id"].dataType.simpleString()
    return map_arrow(src, run, f"id {kind}, n_pretokens long, n_tokens long").withColumnRenamed("id", id_col)
