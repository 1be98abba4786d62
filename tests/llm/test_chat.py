import hashlib
import random
import time
from collections import defaultdict

from clickspark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as formatted", "1 as turns", "2 as blocks")
    return {r.conv_id: tuple(r)[1:5] for r in chat.conversation_digests(df).collect()}


def test_control_strings_in_texts_and_roles(spark):
    rng = random.Random(5)
    bits = ["\\", "#", "<", "### ", ":\n", "</turn>\n", "</part>", "\n", "\\l", "\\b", "\\h", "\\n", "é😀", "", "a", "### assistant:\n"]
    text = lambda: "".join(rng.choices(bits, k=rng.randrange(6)))
    roles = ["user", "assistant", "assistant", "a:\nb", "\\n", "<#", "", None]
    rows = [(c, t, rng.choice(roles), rng.choice([text(), None])) for c in range(150) for t in rng.sample(range(20), rng.randrange(1, 9))]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_ties_nulls_repeats_long_and_empty(spark):
    rows = [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "assistant", "b"), (1, None, "system", None), (None, 2, "assistant", "n"),
            (None, 1, "user", "m"), (2, 0, "assistant", "#<\\" * 60_000), (2, 1, "assistant", ""), (3, 0, None, None)]
    rows += [(4, i, "user" if i % 3 else "assistant", f"t{i}") for i in range(1500)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == {}


def test_layout_and_spans(spark):
    rows = [(1, 0, "user", "a#"), (1, 1, "assistant", "b<"), (1, 2, "assistant", "c\\"), (1, 3, "user", "d")]
    r = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).first()
    assert r.formatted == "### user:\na\\h</turn>\n### assistant:\nb\\l</part>c\\b</turn>\n### user:\nd</turn>\n"
    assert [r.formatted[s.start:s.start + s.length] for s in r.loss_spans] == ["b\\l", "c\\b"]


def test_one_long_conversation_takes_time_in_proportion(spark):
    def digest(n):
        rows = (spark.range(n).selectExpr("1L as conv_id", "id as turn", "if(id % 3 = 0, 'user', 'assistant') as role",
                                          "concat('a<', id, repeat(' b#', 30)) as text"))
        begin = time.time()
        got = chat.conversation_digests(rows).collect()
        return time.time() - begin, tuple(got[0])[:5]

    digest(100)
    short, (_, *got) = digest(5_000)
    assert tuple(got) == brute([(1, i, "assistant" if i % 3 else "user", f"a<{i}" + " b#" * 30) for i in range(5_000)])[1]
    long, _ = digest(20_000)
    assert long < 8 * short                 # quadratic: 16 times


def test_one_shuffle(spark):
    plan = chat.conversation_digests(spark.createDataFrame([(1, 0, "user", "a")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
