"""Chat formatting with Spark expressions only.

Template, one block per run of adjacent turns of one role:

    ### role:\\n  text </part> text ... </turn>\\n

Texts and roles are escaped before they are put in: a backslash becomes
``\\\\b``, '<' becomes ``\\\\l``, '#' becomes ``\\\\h`` (and a line end in a role
``\\\\n``). No escaped text holds '<' or '#', so it holds no marker, and
splitting at the markers and replacing back restores it exactly. Turns merged
into one block stay apart by the part marker. The loss mask covers the texts of
assistant blocks, as spans of the output, and no marker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickspark.llm.text import let

HEAD, COLON, PART, END = "### ", ":\n", "</part>", "</turn>\n"
ASSISTANT = "assistant"
#: (character, written as); the backslash first when escaping, last when reading.
ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("#", "\\h")]


def escape(text: Column) -> Column:
    for raw, written in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for raw, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


def _role_out(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _role_in(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turns): turn structs in order of turn, then role and text; a
    null turn first."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                   F.coalesce(F.col(text), F.lit("")).alias("text"))
    return (conversations.select(F.col(conv).alias("conv_id"), one.alias("t"))
            .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")))


def _blocks(turns: Column) -> Column:
    """Adjacent turns of one role merged: array of (role, texts)."""
    return let(turns, lambda t: let(
        F.filter(F.sequence(F.lit(1), F.size(t)), lambda i: (i == 1) | (F.get(t, i - 1)["role"] != F.get(t, i - 2)["role"])),
        lambda starts: F.transform(starts, lambda s, k: F.struct(
            F.get(t, s - 1)["role"].alias("role"),
            F.transform(F.slice(t, s, F.coalesce(F.get(starts, k + 1), F.size(t) + 1) - s), lambda x: x["text"]).alias("texts")))))


def _block_text(b: Column) -> Column:
    texts = F.array_join(F.transform(b["texts"], escape), PART)
    return F.concat(F.lit(HEAD), _role_out(b["role"]), F.lit(COLON), texts, F.lit(END))


def format_conversations(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    ``loss_spans``: (start, length) in code points of the output, one per
    assistant text, in order. Null role or text counts as empty; an empty
    assistant text has a span of length 0. Rows equal in turn are ordered by
    role and text, repeated rows stay repeated turns. Rows with a null
    conversation id form one conversation. Other columns are ignored.

    One shuffle: turns are collected per conversation, which is the unit of
    output. So one conversation, and with it all rows with a null id, is one row
    in one task: its turns and its output must each stay below Spark's 2 GB for
    an array row or a string, and within the task's memory; beyond, the job
    fails, no row is lost. The starts of the spans are a running sum over the pieces
    as rows, sorted in the same partition, so time grows in proportion to the
    conversation (but for the sort). The README gives measured sizes.
    """
    merged = _turns(conversations, conv, turn, role, text).select("conv_id", _blocks(F.col("turns")).alias("blocks"))
    piece = lambda loss, n: F.struct(loss.alias("loss"), n.alias("n"))
    no = F.lit(False)
    sizes = F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(piece(no, F.length(_role_out(b["role"])) + len(HEAD) + len(COLON))),
        F.flatten(F.transform(b["texts"], lambda t, i: F.array(
            piece(no, F.when(i > 0, len(PART)).otherwise(0)),
            piece(b["role"] == ASSISTANT, F.length(escape(t)))))),
        F.array(piece(no, F.lit(len(END)))))))
    # the output goes with the first piece alone: one copy of it, not one a piece
    pieces = (merged.select("conv_id", F.array_join(F.transform("blocks", _block_text), "").alias("out"), sizes.alias("sizes"))
              .select("conv_id", F.explode(F.transform("sizes", lambda x, i: F.struct(
                  i.alias("pos"), x["loss"].alias("loss"), x["n"].alias("n"), F.when(i == 0, F.col("out")).alias("out")))).alias("p"))
              .select("conv_id", "p.*"))
    after = F.sum("n").over(Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    span = F.struct((after - F.col("n")).cast("int").alias("start"), F.col("n").alias("length"))
    spans = F.when(F.col("loss"), span)
    kept = F.when(F.col("out").isNotNull() | F.col("loss"), F.struct("pos", "out", spans.alias("span")))
    # the output is collected, once; an aggregate that compares it would copy it at every row
    return (pieces.select("conv_id", kept.alias("kept")).groupBy("conv_id").agg(F.array_sort(F.collect_list("kept")).alias("kept"))
            .select("conv_id", F.get("kept", F.lit(0))["out"].alias("formatted"),
                    F.transform(F.filter("kept", lambda x: x["span"].isNotNull()), lambda x: x["span"]).alias("loss_spans")))


def read_turns(formatted: Column) -> Column:
    """The turns, in order, from the formatted text: array of (role, text)."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")
    return F.flatten(F.transform(blocks, lambda b: let(F.instr(b, "\n"), lambda at: F.transform(
        F.split(F.substr(b, at + 1), PART), lambda t: F.struct(
            _role_in(F.substr(b, F.lit(len(HEAD) + 1), at - len(COLON) - len(HEAD))).alias("role"),
            unescape(t).alias("text"))))))


def loss_text(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the output and all unescaped text under its loss mask.

    The output is cut once, before its end and part markers; each piece holds one
    text at its end, so a span that is not empty lies in the piece that starts last before it."""
    one = lambda pos, start, n, piece, out: F.struct(
        pos.alias("pos"), start.alias("start"), n.alias("n"), piece.alias("piece"), out.alias("out"))
    nothing, no_text = F.lit(None).cast("int"), F.lit(None).cast("string")
    cut = F.transform(F.split("formatted", "(?=</(?:turn|part)>)"), lambda x, i: one(
        i, nothing, F.length(x), x, F.when(i == 0, F.col("formatted"))))
    asked = F.transform(F.filter("loss_spans", lambda s: s["length"] > 0), lambda s: one(
        nothing, s["start"], s["length"], no_text, no_text))
    rows = formatted.select("conv_id", F.explode(F.concat(cut, asked)).alias("r")).select("conv_id", "r.*")
    size = F.when(F.col("piece").isNotNull(), F.col("n")).otherwise(0)
    in_order = Window.partitionBy("conv_id").orderBy(F.col("pos").asc_nulls_last())
    begin = F.sum(size).over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - size
    placed = rows.withColumn("at", F.coalesce("start", begin.cast("int")))
    so_far = (Window.partitionBy("conv_id").orderBy("at", F.col("piece").isNull())
              .rowsBetween(Window.unboundedPreceding, 0))
    held = F.last(F.when(F.col("piece").isNotNull(), F.struct("at", "piece")), ignorenulls=True).over(so_far)
    text = F.when(F.col("piece").isNull(), unescape(F.substr(F.col("held.piece"), F.col("at") - F.col("held.at") + 1, F.col("n"))))
    found = placed.withColumn("held", held).select("conv_id", F.when(
        F.col("out").isNotNull() | F.col("piece").isNull(), F.struct("at", "out", text.alias("text"))).alias("hit"))
    # the output comes first: no text under the mask starts at 0
    return (found.groupBy("conv_id").agg(F.array_sort(F.collect_list("hit")).alias("hits"))
            .select("conv_id", F.get("hits", F.lit(0))["out"].alias("formatted"),
                    F.array_join(F.transform("hits", lambda h: h["text"]), "").alias("loss")))


def conversation_digests(conversations: DataFrame, **columns: str) -> DataFrame:
    """What is read back from the output: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    done = loss_text(format_conversations(conversations, **columns))
    read = done.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
                       "loss", read_turns(F.col("formatted")).alias("turns"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars")
