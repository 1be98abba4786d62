"""Cross-tokenizer alignment: byte offsets where the tokens of two tokenizers both end.

Tokenizer A is byte-level BPE, tokenizer B a BPE of pieces with byte fallback that
puts a space before the text; A encodes the text with that space. Between two
offsets where tokens of both end lies a group: some A tokens and some B tokens
that spell the same bytes. The last A and the last B token of a group end
together and are linked.

A document's groups are composed from fragments. A fragment covers the tokens that
start in a byte range and is an open prefix (up to the first common end), closed
groups, and an open suffix (after the last). ``combine`` is associative: suffix
and prefix are put together and cut anew, whatever closes is a group. Documents
longer than a chunk are dealt out as byte ranges, each tokenised by a task of its
own, and composed by a tree of combinations across tasks; only the open ends climb
the tree.

Both tokenizers treat the text between two safe cuts (a space or line feed after
something that is no white space) by itself, so a range is tokenised with no more
than the text between the safe cuts around it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clickspark.llm.bpe import new_query, of_process
from clickspark.llm.packing import _byte_letters, _tokenizer
from clickspark.llm.tasks import map_arrow, ship
from clickspark.session import scratch_path

#: Bytes of a range of a long document; combinations per task of the tree.
CHUNK_BYTES, FAN_IN = 1 << 16, 16
#: Links of a block: documents that look up their counts together in one task.
BLOCK_LINKS = 1 << 21
SPACE_PIECE = "▁"

_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_LONG_SPACE = re.compile(r"\s{1000}")
Tokens = list[tuple[int, int]]              # (id, byte offset of its end)
Group = tuple[int, list[int], list[int]]    # byte offset of its end, A ids, B ids


class Aligner:
    """Both tokenizers."""

    def __init__(self, a_definition: str, b_model: bytes, pattern: str):
        import sentencepiece
        import tiktoken
        from sentencepiece import sentencepiece_model_pb2
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(b_model)
        texts = [p.piece for p in spec.pieces if p.type != p.BYTE]
        if (spec.normalizer_spec.name != "identity" or not spec.normalizer_spec.add_dummy_prefix or spec.normalizer_spec.remove_extra_whitespaces
                or not spec.trainer_spec.byte_fallback or any(re.search(f"[^{SPACE_PIECE}]{SPACE_PIECE}|.\n|\n.", t, re.S) for t in texts)):
            raise ValueError("tokenizer B must keep its text, begin with a space, and have no piece across a space or line feed")
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.lone_space = self.b.piece_to_id(SPACE_PIECE)
        b_bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == p.BYTE else p.piece.replace(SPACE_PIECE, " ").encode() for p in spec.pieces]
        parts = json.loads(a_definition)
        vocab, merges = parts["model"]["vocab"], parts["model"]["merges"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        if parts["normalizer"] or (parts["pre_tokenizer"] or {}).get("type") != "ByteLevel" or made != sorted(made):
            raise ValueError("tokenizer A must be byte-level, without normalizer, with ids in the order of its merges")
        self.letters, self.pattern = _byte_letters(), regex.compile(pattern)
        back = {c: b for b, c in self.letters.items()}
        ranks = {bytes(back[c] for c in t): i for t, i in vocab.items() if all(c in back for c in t)}
        # ids ascend with the merges, so merging by rank is merging in their order
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.a_model = _tokenizer(a_definition).model
        a_bytes = [b""] * (max(ranks.values()) + 1)
        for data, i in ranks.items():
            a_bytes[i] = data
        self.bytes = a_bytes, b_bytes
        self.sizes = tuple(np.array([len(x) for x in side], np.int64) for side in self.bytes)
        # a token as written in a group: followed by a comma, or by the end of its side
        self.written = [f"{i}{end}" for side, last in ((a_bytes, "|"), (b_bytes, ";")) for i in range(len(side)) for end in (",", last)]

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """A and B ids of a text that begins with a space or line feed and lies between safe cuts."""
        if _LONG_SPACE.search(text):        # too deep a recursion for the splitter of tiktoken
            a = [t.id for part in self.pattern.findall(text) for t in self.a_model.tokenize(part.encode().decode("latin-1").translate(self.letters))]
        else:
            a = self.a.encode_to_numpy(text)
        # B puts a space before what it encodes: the text's own, or one to be taken off
        b = [self.lone_space] if text == " " else self.b.encode(text[1:], num_threads=1) if text[0] == " " else self.b.encode(text, num_threads=1)[1:]
        return np.asarray(a, np.int64), np.array(b, np.int64)

    def spells(self, ids: tuple[np.ndarray, np.ndarray], text: str) -> bool:
        data = text.encode()
        return all(b"".join(map(side.__getitem__, i.tolist())) == data for side, i in zip(self.bytes, ids, strict=True))

    def tokens(self, text: str, at: int) -> tuple[Tokens, Tokens]:
        """A and B tokens of such a text that begins at byte ``at``."""
        ids = self.ids(text)
        if not self.spells(ids, text):
            raise ValueError(f"tokens do not spell their text: {text[:100]!r}")
        return tuple(list(zip(i.tolist(), (at + size[i].cumsum()).tolist(), strict=True)) for i, size in zip(ids, self.sizes, strict=True))

    def aligned(self, text: str) -> tuple[str, np.ndarray, int, int] | None:
        """(groups as text, links as 64-bit numbers, A tokens, B tokens) of a whole
        text; None if the tokens do not spell it. ``cut``, in vectors."""
        a, b = ids = self.ids(text)
        if not self.spells(ids, text):
            return None
        a_end, b_end = (size[i].cumsum() for i, size in zip(ids, self.sizes, strict=True))
        at = np.searchsorted(b_end, a_end)              # both end at the text's end
        a_last = b_end[at] == a_end
        b_last = np.zeros(len(b), bool)
        b_last[at[a_last]] = True
        # a group's A tokens, then its B tokens
        a_stop, b_stop = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
        said = np.empty(len(a) + len(b), np.int64)
        said[np.arange(len(a)) + np.append(0, b_stop)[a_last.cumsum() - a_last]] = 2 * a + a_last
        said[np.arange(len(b)) + a_stop[b_last.cumsum() - b_last]] = 2 * (len(self.bytes[0]) + b) + b_last
        return "".join(map(self.written.__getitem__, said.tolist()))[:-1], a[a_last] << 32 | b[b_last], len(a), len(b)


def cut(a: Tokens, b: Tokens) -> tuple[list[Group], Tokens, Tokens]:
    """Groups up to the last common end, and the A and B tokens after it."""
    groups, i, j, from_a, from_b = [], 0, 0, 0, 0
    while i < len(a) and j < len(b):
        x, y = a[i][1], b[j][1]
        if x == y:
            groups.append((x, [t for t, _ in a[from_a:i + 1]], [t for t, _ in b[from_b:j + 1]]))
            i, j = i + 1, j + 1
            from_a, from_b = i, j
        elif x < y:
            i += 1
        else:
            j += 1
    return groups, a[from_a:], b[from_b:]


def _written(groups: list[Group]) -> tuple[str, np.ndarray]:
    text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for _, a, b in groups)
    return text, np.array([a[-1] << 32 | b[-1] for _, a, b in groups], np.int64)


@dataclass
class Fragment:
    """Tokens that start in a range. ``split``: a common end lies within; else all
    tokens are in the head. Closed groups are not kept here."""
    split: bool = False
    head_a: Tokens = field(default_factory=list)
    head_b: Tokens = field(default_factory=list)
    tail_a: Tokens = field(default_factory=list)
    tail_b: Tokens = field(default_factory=list)


def fragment(a: Tokens, b: Tokens) -> tuple[Fragment, list[Group]]:
    """Fragment of the tokens of a range, and its closed groups."""
    groups, rest_a, rest_b = cut(a, b)
    if not groups:
        return Fragment(False, a, b), []
    end = groups[0][0]
    return Fragment(True, [t for t in a if t[1] <= end], [t for t in b if t[1] <= end], rest_a, rest_b), groups[1:]


def combine(x: Fragment, y: Fragment) -> tuple[Fragment, list[Group]]:
    """The fragment of two neighbouring ranges and the groups that close between
    them. Associative; the empty fragment is neutral."""
    if not x.split:
        joined, groups = fragment(x.head_a + y.head_a, x.head_b + y.head_b)
        if y.split:                         # the prefix of y ends at a common end, so all of it is cut
            joined = Fragment(True, joined.head_a, joined.head_b, y.tail_a, y.tail_b)
        return joined, groups
    groups, rest_a, rest_b = cut(x.tail_a + y.head_a, x.tail_b + y.head_b)
    return Fragment(True, x.head_a, x.head_b, *((y.tail_a, y.tail_b) if y.split else (rest_a, rest_b))), groups


def ranges(text: str, size: int) -> Iterator[tuple[int, int, int, str]]:
    """Byte ranges of the text (first byte, byte after the last) with the text between
    the safe cuts around them (its first byte, itself). A range ends after ``size``
    characters, or, inside a unit longer than a quarter of that, at the unit's end;
    so no part of a text is tokenised more than twice."""
    at, low, window, window_low = 0, 0, 0, 0
    while at < len(text):
        end = min(len(text), at + size)
        stop = len(text)
        if end < len(text):
            last, back = None, 64
            while last is None and back < 2 * size + 64:
                last = next((m.start() for m in reversed(list(_CUT.finditer(text, max(at, end - back), min(len(text), end + 2)))) if m.start() <= end), None)
                back *= 4
            after = _CUT.search(text, end)
            stop = after.start() if after else len(text)
            begin = at if last is None else last
            if stop - begin > size // 4:
                begin = end = stop
        high = low + len(text[at:end].encode())
        yield low, high, window_low, text[window:stop]
        if end < len(text):
            window, window_low = begin, high - len(text[begin:end].encode())
        at, low = end, high


def range_fragment(aligner: Aligner, low: int, high: int, start: int, text: str) -> tuple[Fragment, list[Group]]:
    """The fragment of a range, and its closed groups. The text lies between the
    safe cuts around the range and begins at byte ``start``."""
    return fragment(*[[(t, e) for (t, e), s in zip(side, [start, *(e for _, e in side)], strict=False) if low <= s < high]
                      for side in aligner.tokens(text, start)])


_SIDES = ("head_a", "head_b", "tail_a", "tail_b")
_PARTS = ", ".join(f"{s}_ids array<long>, {s}_ends array<long>" for s in _SIDES)
_PIECE = ("block long, id {id}, key long, at long, n_a long, n_b long, n_groups long, sha string, groups string, refs binary, times binary, "
          "pair long, n long, chunk long, split boolean, " + _PARTS)


def _arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def _piece_schema(id_type: pa.DataType) -> pa.Schema:
    ints, lists = pa.int64(), pa.list_(pa.int64())
    return pa.schema([("block", ints), ("id", id_type), ("key", ints), ("at", ints), ("n_a", ints), ("n_b", ints), ("n_groups", ints), ("sha", pa.string()),
                      ("groups", pa.string()), ("refs", pa.binary()), ("times", pa.binary()), ("pair", ints), ("n", ints), ("chunk", ints), ("split", pa.bool_()),
                      *[(f"{s}_{x}", lists) for s in _SIDES for x in ("ids", "ends")]])


def _blocks(pieces: Iterable[dict], id_type: pa.DataType, of: int) -> Iterator[pa.RecordBatch]:
    """Pieces (with ``links``) in blocks: a piece names its distinct links by their
    place among the block's, which follow it as rows (pair, n)."""
    schema, held, size = _piece_schema(id_type), [], 0
    block = TaskContext.get().partitionId() * 1000 + of << 24

    def emitted() -> Iterator[pa.RecordBatch]:
        every, where = np.unique(np.concatenate([p["links"][0] for p in held]), return_inverse=True)
        total = np.bincount(where, np.concatenate([p["links"][1] for p in held]), len(every)).astype(np.int64) if len(every) else np.zeros(0, np.int64)
        at = 0
        for p in held:
            n = len(p["links"][0])
            p |= {"block": block, "refs": where[at:at + n].astype("<i4").tobytes(), "times": p["links"][1].astype("<i4").tobytes()}
            at += n
        for at in range(0, len(held), 1024):
            yield _arrow(held[at:at + 1024], schema)
        if len(every):
            empty = {f.name: pa.nulls(len(every), f.type) for f in schema}
            empty |= {"block": pa.array(np.full(len(every), block)), "pair": pa.array(every), "n": pa.array(total)}
            yield pa.RecordBatch.from_arrays([empty[f.name] for f in schema], schema=schema)

    for p in pieces:
        p["links"] = np.unique(p["links"], return_counts=True)
        held.append(p)
        size += len(p["links"][0]) + 64
        if size >= BLOCK_LINKS:
            yield from emitted()
            held, size, block = [], 0, block + 1
    if held:
        yield from emitted()


def _whole(aligner: Aligner, i, text: str | None, keep: bool) -> dict:
    """The piece of a document that is not dealt out."""
    found = aligner.aligned(" " + text) if text and SPACE_PIECE not in text else None   # B writes a space for this letter
    said, links, n_a, n_b = found or ("", np.zeros(0, np.int64), 0, 0)
    return {"id": i, "n_a": n_a, "n_b": n_b, "n_groups": len(links), "sha": hashlib.sha256(said.encode()).hexdigest() if found else "",
            "links": links, "groups": said if keep else None}


def _lists(f: Fragment) -> dict:
    return {"split": f.split} | {f"{s}_{x}": [t[k] for t in getattr(f, s)] for s in _SIDES for k, x in enumerate(("ids", "ends"))}


def _from_lists(row: dict) -> Fragment:
    return Fragment(row["split"], *[list(zip(row[f"{s}_ids"], row[f"{s}_ends"], strict=True)) for s in _SIDES])


@dataclass(frozen=True)
class Alignment:
    """``documents``: id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256. ``pair_counts``: a, b, links, best (no other A token is linked
    to b more often). ``groups``: id, key, at, groups, in order of ``at``; a document
    that is not dealt out has one row without key and at (if asked for)."""
    documents: DataFrame
    pair_counts: DataFrame
    groups: DataFrame


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
          chunk_bytes: int = CHUNK_BYTES, keep_groups: bool = False) -> Alignment:
    """Alignment of every row; see ``Alignment``.

    A null or empty text, and a text with U+2581 (which B would spell as a space),
    has no tokens: zeros, and '' as digest; it takes no part in the counts. Every
    repeated row is a document of its own and counts again; null ids are kept. Empty
    tables give no rows. Other columns are ignored. Ties for the most frequent A token
    of a B token are all best.

    Texts of over ``chunk_bytes`` bytes are dealt out. Blocks of links, ranges and
    the rounds of the tree are written once to the shared folder. Memory of a task: a
    block of links and the tokens of one range; a digest streams over a document's pieces.
    """
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as fa, open(b_path, "rb") as fb:
        shared = spark.sparkContext.broadcast((fa.read(), fb.read(), pattern))
    query = new_query()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, id_type = src.schema["id"].dataType.simpleString(), to_arrow_type(src.schema["id"].dataType)
    piece = _PIECE.format(id=kind)
    long = F.coalesce((F.octet_length("text") > chunk_bytes) & ~F.contains("text", F.lit(SPACE_PIECE)), F.lit(False))

    def aligner() -> Aligner:
        return of_process("align", query, lambda: Aligner(*shared.value))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _blocks((_whole(aligner(), i.as_py(), t.as_py(), keep_groups) for b in batches for i, t in zip(*b.columns, strict=True)), id_type, 0)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                one = b.slice(row, 1)
                for chunk, (low, high, start, text) in enumerate(ranges(" " + one.column(1)[0].as_py(), chunk_bytes)):
                    yield pa.RecordBatch.from_arrays([one.column(0), one.column(2), *[pa.array([x], pa.int64()) for x in (chunk, low, high, start)],
                                                      pa.array([text])], names=["id", "key", "chunk", "low", "high", "start", "text"])

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[dict]:
            for b in batches:
                for r in (r for at in range(0, b.num_rows, 16) for r in b.slice(at, 16).to_pylist()):
                    open_ends, inner = range_fragment(aligner(), r["low"], r["high"], r["start"], r["text"])
                    said, links = _written(inner)
                    yield {"key": r["key"], "chunk": r["chunk"], "at": inner[0][0] if inner else None, "n_a": sum(len(g[1]) for g in inner),
                           "n_b": sum(len(g[2]) for g in inner), "n_groups": len(inner), "groups": said if inner else None, "links": links} | _lists(open_ends)
        yield from _blocks(pieces(), id_type, 1)

    short = map_arrow(src.where(~long), whole, piece)
    dealt = _stored(map_arrow(src.where(long).withColumn("key", F.monotonically_increasing_id()), deal,
                              f"id {kind}, key long, chunk long, low long, high long, start long, text string"), "align-ranges")
    chunks = dealt.agg(F.max("chunk")).first()[0]
    blocks = _stored(short, "align-blocks")
    if chunks is not None:
        inner = _stored(map_arrow(dealt.select("key", "chunk", "low", "high", "start", "text").repartition("key", "chunk"), opened, piece), "align-chunks")
        seams = _tree(inner.where("chunk is not null"), chunks + 1, piece, id_type)
        blocks = blocks.unionByName(inner).unionByName(seams)

    totals = blocks.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("links"))
    b_id = F.col("pair").bitwiseAND(0xFFFFFFFF)
    totals = _stored(totals.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy(b_id))), "align-pairs")
    wanted = blocks.where("pair is not null").select("block", "pair").join(totals, "pair").select(F.col("block").alias("of"), "pair", "links", "best")
    pieces = blocks.where("pair is null").select("block", "id", "key", "n_a", "n_b", "n_groups", "sha", "refs", "times")

    def counted(held: pa.Table, counts: pa.Table) -> pa.Table:
        counts = counts.sort_by("pair")
        links, best = counts["links"].to_numpy(), counts["best"].to_numpy(zero_copy_only=False) if counts.num_rows else np.zeros(0, bool)
        n_best, total = [], []
        for refs, times in zip(held["refs"].to_pylist(), held["times"].to_pylist(), strict=True):
            r, t = np.frombuffer(refs, "<i4"), np.frombuffer(times, "<i4").astype(np.int64)
            n_best.append(int(t[best[r]].sum()))
            total.append(int((t * links[r]).sum()))
        return (held.drop_columns(["block", "refs", "times"]).append_column("n_best", pa.array(n_best, pa.int64()))
                .append_column("count_sum", pa.array(total, pa.int64())))

    ship(spark)
    rows = pieces.groupBy("block").cogroup(wanted.groupBy("of")).applyInArrow(
        counted, f"id {kind}, key long, n_a long, n_b long, n_groups long, sha string, n_best long, count_sum long")
    measures = ("n_a", "n_b", "n_groups", "n_best", "count_sum")
    if chunks is not None:
        rows = _stored(rows, "align-rows")
        sums = rows.where("key is not null").groupBy("key").agg(*[F.sum(c).alias(c) for c in measures])
        ids = dealt.where("chunk = 0").select("id", F.col("key").alias("of"))
        shas = _digests(blocks).withColumnRenamed("key", "s_key")
        dealt_rows = (sums.join(ids, F.col("key") == F.col("of")).join(shas, F.col("key") == F.col("s_key"))
                      .select("id", "key", *measures, "sha"))
        rows = rows.where("key is null").select("id", "key", *measures, "sha").unionByName(dealt_rows)
        names = ids
    documents = rows.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum",
                            F.col("sha").alias("groups_sha256"))
    said = blocks.where("groups is not null").select("id", "key", "at", "groups")
    if chunks is not None:
        said = (said.join(names, F.col("key") == F.col("of"), "left")
                .select(F.coalesce(said["id"], names["id"]).alias("id"), "key", "at", "groups"))
    return Alignment(documents, totals.select(F.shiftright("pair", 32).alias("a"), b_id.alias("b"), "links", "best"),
                     said.withColumnRenamed("id", id_col))


def _tree(ends: DataFrame, chunks: int, piece: str, id_type: pa.DataType) -> DataFrame:
    """Combines the open ends of every document's ranges, FAN_IN at a time, until one
    fragment is left; returns the groups that close on the way, as blocks."""
    closed = None
    schema = "kind int, key long, chunk long, at long, n_a long, n_b long, groups string, links binary, split boolean, " + _PARTS
    fields = pa.schema([("kind", pa.int32()), *[(n, pa.int64()) for n in ("key", "chunk", "at", "n_a", "n_b")], ("groups", pa.string()), ("links", pa.binary()),
                        ("split", pa.bool_()), *[(f"{s}_{x}", pa.list_(pa.int64())) for s in _SIDES for x in ("ids", "ends")]])
    cur = ends.select("key", "chunk", "split", *[f"{s}_{x}" for s in _SIDES for x in ("ids", "ends")])

    def composed(last: bool):
        def run(key: tuple, table: pa.Table) -> pa.Table:
            whole, groups = Fragment(), []
            for r in table.sort_by("chunk").to_pylist():
                whole, more = combine(whole, _from_lists(r))
                groups += more
            if last:                        # a document begins and ends at a common end
                groups += cut(whole.head_a, whole.head_b)[0]
                assert whole.split and not whole.tail_a and not whole.tail_b
            doc, place = (k.as_py() for k in key)
            out = [] if last else [{"kind": 0, "key": doc, "chunk": place} | _lists(whole)]
            for g in groups:
                said, links = _written([g])
                out.append({"kind": 1, "key": doc, "at": g[0], "n_a": len(g[1]), "n_b": len(g[2]), "groups": said, "links": links.tobytes()})
            return pa.Table.from_batches([_arrow(out, fields)])
        return run

    while True:
        last = chunks <= FAN_IN
        ship(cur.sparkSession)
        placed = cur.withColumn("place", F.floor(F.col("chunk") / FAN_IN))
        out = _stored(placed.groupBy("key", "place").applyInArrow(composed(last), schema), "align-tree")
        groups = out.where("kind = 1").select("key", "at", "n_a", "n_b", "groups", "links")
        closed = groups if closed is None else closed.unionByName(groups)
        if last:
            break
        cur, chunks = out.where("kind = 0").select(*cur.columns), -(-chunks // FAN_IN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _blocks((r | {"n_groups": 1, "links": np.frombuffer(r["links"], "<i8")} for b in batches for r in b.to_pylist()), id_type, 2)

    return _stored(map_arrow(closed, run, piece), "align-seams")


def _digests(blocks: DataFrame) -> DataFrame:
    """(key, sha) of the dealt documents: their groups in order, hashed as they stream by."""
    parts = (blocks.where("key is not null and groups is not null").select("key", "at", "groups")
             .repartition("key").sortWithinPartitions("key", "at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []
        for b in batches:
            for k, said in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                if k != key:
                    if key is not None:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b";")
                sha.update(said.as_py().encode())
        if key is not None:
            out.append((key, sha.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([s for _, s in out], pa.string())], names=["key", "sha"])

    return map_arrow(parts, run, "key long, sha string")
