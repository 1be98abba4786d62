"""Conversation structure repair: the cheapest edits that make roles alternate.

The rows of a conversation, in turn order, span an edit lattice: a node is (rows
consumed, state of the role pattern ``(s?(ua)+)?``), an edge an edit of the next
row (keep, rerole, delete) or an insertion. ``cheapest_edits`` searches it with
Dijkstra's algorithm from both ends: a forward and a reverse heap, until the two
smallest keys add up to more than the best crossing, so that every crossing of
equal cost is known; among the cheapest paths it takes the one whose edit
initials, written one after another, sort first.

The search sees one small number per row, never a text. Texts stream past the
finished audit in sorted order, so a task holds no conversation's texts.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickspark.llm.tasks import map_arrow
from clickspark.llm.text import SPACES
from clickspark.session import scratch_path

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
INITIALS = "sua"                            # any other initial is the kind after these
#: Pattern states: nothing yet, after s, after u, after a. The pattern ends in 0 or 3.
KEEP_TO = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None, None, None, None))
NEXT = (2, 2, 3, 2)                         # the state after the one role that may be put next
ROLES = {2: "user", 3: "assistant"}
ENDS = (0, 3)
FINE, MUST_GO, CUT_OFF = 0, 1, 2
_INF = 1 << 30

AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def cheapest_edits(rows: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation whose row i is ``kind + 4 * fault``."""
    n = len(rows)
    width = 4 * (n + 1)

    def after(node: int) -> Iterator[tuple[str, int, int]]:
        """(initial, cost, next node) by ascending initial."""
        i, q = node >> 2, node & 3
        if i == n:
            yield "I", INSERT, (node & ~3) + NEXT[q]
            return
        kind, fault = rows[i] & 3, rows[i] >> 2
        yield "D", DELETE, node + 4
        yield "I", INSERT, (node & ~3) + NEXT[q]
        if fault != MUST_GO:
            more = TRUNCATED if fault == CUT_OFF else 0
            if (to := KEEP_TO[kind][q]) is not None:
                yield "K", more, (node & ~3) + 4 + to
            yield "R", REROLE + more, (node & ~3) + 4 + NEXT[q]

    def before(node: int) -> Iterator[tuple[int, int]]:
        """(cost, previous node)."""
        i, q = node >> 2, node & 3
        base = node & ~3
        from_next = [p for p in range(4) if NEXT[p] == q]
        for p in from_next:
            yield INSERT, base + p
        if i:
            kind, fault = rows[i - 1] & 3, rows[i - 1] >> 2
            yield DELETE, node - 4
            if fault != MUST_GO:
                more = TRUNCATED if fault == CUT_OFF else 0
                for p in range(4):
                    if KEEP_TO[kind][p] == q:
                        yield more, base - 4 + p
                for p in from_next:
                    yield REROLE + more, base - 4 + p

    start, ends = 0, [4 * n + q for q in ENDS]
    ahead, back = array("i", [_INF]) * width, array("i", [_INF]) * width
    sure_ahead, sure_back = bytearray(width), bytearray(width)
    ahead[start], forward, reverse = 0, [start], []         # heap keys: cost * width + node
    for e in ends:
        back[e] = 0
        heappush(reverse, e)
    best = 0 if n == 0 else _INF
    while forward and reverse and forward[0] // width + reverse[0] // width <= best:
        if forward[0] // width <= reverse[0] // width:
            cost, node = divmod(heappop(forward), width)
            if sure_ahead[node]:
                continue
            sure_ahead[node] = 1
            for _, w, to in after(node):
                if cost + w < ahead[to]:
                    ahead[to] = cost + w
                    heappush(forward, (cost + w) * width + to)
                    best = min(best, cost + w + back[to])
        else:
            cost, node = divmod(heappop(reverse), width)
            if sure_back[node]:
                continue
            sure_back[node] = 1
            for w, to in before(node):
                if cost + w < back[to]:
                    back[to] = cost + w
                    heappush(reverse, (cost + w) * width + to)
                    best = min(best, cost + w + ahead[to])
    # every node of a cheapest path is settled from one side at least; mark those
    # settled from the front that lead to a crossing (a sum equal to the best cost
    # proves both of its parts exact)
    on_path = bytearray(width)
    todo = [u for u in range(width) if sure_ahead[u] and (
        ahead[u] + back[u] == best or any(ahead[u] + w + back[v] == best for _, w, v in after(u)))]
    for u in todo:
        on_path[u] = 1
    while todo:
        u = todo.pop()
        for w, p in before(u):
            if sure_ahead[p] and not on_path[p] and ahead[p] + w == ahead[u]:
                on_path[p] = 1
                todo.append(p)
    node, spent, audit = start, 0, []
    while spent < best or node not in ends:
        for initial, w, to in after(node):
            if spent + w + back[to] == best or (on_path[to] and ahead[to] == spent + w):
                audit.append(initial)
                node, spent = to, spent + w
                break
        else:
            raise AssertionError("no edit leads on")
    return best, "".join(audit)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``there`` (false: the damage dropped the
    row), by crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2
    removes ``[.!?]``, 3 repeats it, 4 sets the role to user. Null text and role
    count as one space, as do null ids and turns in the checksum."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    role = F.when(code == 4, "user").otherwise(shown("role"))
    return (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 role.alias("role"), text.alias("text"), code.alias("code"),
                                 F.explode(F.array_repeat(F.lit(0), F.when(code == 3, 2).otherwise(1))))
            .select("conv_id", "turn", "role", "text", (F.col("code") != 0).alias("there")))


def _rows(conversations: DataFrame) -> DataFrame:
    there = F.col("there") if "there" in conversations.columns else F.lit(True)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), there.alias("there"))


#: Order of a conversation's rows; ties in turn by role, then by digest of the text.
_ORDER = ("turn", "role", "digest")         # ascending, nulls first


def audit(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit.

    Input: conv_id, turn, role, text and, if given, ``there``; rows where it is
    false only name their conversation. Null role or text counts as one space.
    Rows go by turn, nulls first; rows of one turn by role, then by MD5 of the
    text (the same digest finds duplicates), so identical rows are adjacent.
    Rows with a null conv_id are one conversation. A role initial other than s, u,
    a (an empty role too) fits nowhere: such a row is reroled or deleted. A
    conversation without rows has zeros and an empty audit; an empty table none.
    Other columns are ignored.

    Memory of a task: about 200 bytes per row of its longest conversation.
    """
    rows = _rows(conversations)
    ended: Column = F.rtrim(F.col("text"), F.lit(SPACES))
    last = F.substring(ended, -1, 1)
    kind = F.coalesce(F.nullif(F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) * (F.length("role") > 0).cast("int"), F.lit(0)), F.lit(4)) - 1
    fault = F.when(ended == "", 0).when(last.isin(".", "!", "?"), 2).otherwise(1)
    seen = Window.partitionBy("conv_id", "there", "role", "digest").orderBy("turn")
    small = (rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"), kind.alias("kind"), fault.alias("fault"), "there")
             .repartition("conv_id")        # the window and the search share this one shuffle
             .withColumn("again", F.row_number().over(seen) > 1)
             .sortWithinPartitions("conv_id", F.desc("there"), *_ORDER)
             .select("conv_id", "turn", "kind", "fault", "again", "there"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        none = object()
        conv = none

        def closed() -> tuple:
            cost, edits = cheapest_edits(bytes(codes))
            return conv, (turns[1] - turns[0] + 1 - turns[2]) if turns else 0, *found, illegal, cost, edits

        for b in batches:
            for c, turn, kind, fault, again, there in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if conv is none or c != conv:
                    if conv is not none:
                        out.append(closed())
                    conv, codes, turns, found, illegal = c, bytearray(), None, [0, 0, 0], 0
                if not there:
                    continue
                if turn is not None:
                    turns = [turn, turn, 1] if turns is None else [turns[0], turn, turns[2] + (turn != turns[1])]
                which = 0 if fault == 0 else 1 if again else 2 if fault == 1 else 3
                if which < 3:
                    found[which] += 1
                if codes:
                    illegal += (codes[-1] & 3, kind) not in ((0, 1), (1, 2), (2, 1))
                codes.append(kind + 4 * (MUST_GO, MUST_GO, CUT_OFF, FINE)[which])
            yield _table(out, AUDIT)
            out = []
        if conv is not none:
            yield _table([closed()], AUDIT)

    return map_arrow(small, run, AUDIT)


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(
        zip(*rows, strict=True) if rows else [()] * len(fields), fields, strict=True)], names=[n for n, _ in fields])


REPAIRED = "conv_id long, position long, edit string, role string, text string"


def repair(conversations: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, position (from 0), edit (K, R or I), role, text.

    ``audits`` is ``audit(conversations)``. Rows of a conversation come one after
    another, in order, in one partition. Deleted rows are left out.
    """
    rows = _rows(conversations).where("there").select(
        "conv_id", F.lit(1).alias("part"), "turn", "role", F.md5("text").alias("digest"), "text", F.lit(None).cast("string").alias("audit"))
    plans = audits.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.lit("").alias("digest"), F.lit("").alias("text"), "audit")
    stream = (rows.unionByName(plans).repartition("conv_id")
              .sortWithinPartitions("conv_id", "part", *_ORDER)
              .select("conv_id", "part", "role", "text", "audit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, edits, at, state, position = None, "", 0, 0, 0

        def inserted() -> None:
            nonlocal at, state, position
            while at < len(edits) and edits[at] == "I":
                state = NEXT[state]
                out.append((conv, position, "I", ROLES[state], ""))
                at, position = at + 1, position + 1

        for b in batches:
            for c, part, role, text, plan in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if part == 0:
                    conv, edits, at, state, position = c, plan, 0, 0, 0
                    inserted()
                    continue
                edit = edits[at]
                at += 1
                if edit != "D":
                    kind = INITIALS.find(role[:1]) if role else -1
                    state = KEEP_TO[kind][state] if edit == "K" else NEXT[state]
                    out.append((conv, position, edit, role if edit == "K" else ROLES[state], text))
                    position += 1
                inserted()
            yield _table(out, REPAIRED)
            out = []

    return map_arrow(stream, run, REPAIRED)


def digest(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the output of ``repair``: ``role:text``, joined
    by newlines. Streams over its partitions; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        conv, sha = none, None
        out: list[tuple] = []
        for b in batches:
            for c, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if conv is none or c != conv:
                    if conv is not none:
                        out.append((conv, sha.hexdigest()))
                    conv, sha = c, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield _table(out, "conv_id long, repaired_sha256 string")
            out = []
        if conv is not none:
            yield _table([(conv, sha.hexdigest())], "conv_id long, repaired_sha256 string")

    return map_arrow(repaired.select("conv_id", "role", "text"), run, "conv_id long, repaired_sha256 string")


def repair_digests(conversations: DataFrame) -> DataFrame:
    """``audit`` and the digest of the repaired conversation; the digest of
    nothing where no row is left. The audits are written once to the shared folder."""
    spark = conversations.sparkSession
    path = scratch_path(spark, "repair-audits")
    audit(conversations).write.parquet(path)
    audits = spark.read.schema(AUDIT).parquet(path)
    hashes = digest(repair(conversations, audits)).withColumnRenamed("conv_id", "h_id")
    return (audits.join(hashes, F.col("conv_id").eqNullSafe(F.col("h_id")), "left")
            .select(*audits.columns, F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))
