import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from clickspark.llm import repair
from llm_data import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, id string, audit string, there_not boolean"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def least_edits(rows):
    """Cost and audit by relaxing every lattice edge until nothing changes; rows
    are (role initial, must go, truncated)."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    put = {"": "u", "s": "u", "u": "a", "a": "u"}
    level = {"": (0, "")}

    def add(to, state, value):
        if state not in to or value < to[state]:
            to[state] = value
            return True
        return False

    def insertions(at):
        while any([add(at, put[q], (c + 3, a + "I")) for q, (c, a) in list(at.items())]):
            pass

    insertions(level)
    for initial, gone, cut in rows:
        nxt = {}
        for q, (c, a) in level.items():
            add(nxt, q, (c + 4, a + "D"))
            if not gone:
                if initial in after[q]:
                    add(nxt, after[q][initial], (c + 3 * cut, a + "K"))
                add(nxt, put[q], (c + 3 + 3 * cut, a + "R"))
        insertions(nxt)
        level = nxt
    return min(level[q] for q in ("", "a") if q in level)


def damaged(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        shown = lambda x: " " if x is None else str(x)
        code = zlib.crc32(f"{shown(c)}:{shown(t)}".encode()) % 20
        role, text = shown(role), shown(text)
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out[c] += [(t, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def brute(conversations):
    out = []
    for c, rows in conversations.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        turns = [t for t, _, _ in rows if t is not None]
        seen, found, lattice, kinds = set(), [0, 0, 0], [], []
        for _, role, text in rows:
            words = BLANK.findall(text)
            which = 0 if not words else 1 if (role, text) in seen else 2 if words[-1] not in ".!?" else None
            seen.add((role, text))
            if which is not None:
                found[which] += 1
            lattice.append((role[:1], which in (0, 1), which == 2))
            kinds.append(role[:1])
        cost, audit = least_edits(lattice)
        said, state, left = [], "", iter(rows)
        for e in audit:
            role, text = ("", "") if e == "I" else next(left)[1:]
            if e in "IR":
                role = "assistant" if state == "u" else "user"
            if e != "D":
                state = role[0]
                said.append(f"{role}:{text}")
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(kinds))
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *found, illegal, cost, audit,
                    hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(df):
    return sorted(map(tuple, repair.repair_digests(df).collect()), key=repr)


def test_search_equals_relaxation():
    rng = random.Random(3)
    for _ in range(3000):
        rows = [(rng.choice(["s", "u", "a", "a", "u", "t", ""]), *rng.choice([(0, 0), (0, 0), (1, 0), (0, 1)])) for _ in range(rng.randrange(9))]
        codes = bytes({"s": 0, "u": 1, "a": 2}.get(k, 3) + 4 * (repair.MUST_GO if g else repair.CUT_OFF if t else repair.FINE) for k, g, t in rows)
        assert repair.cheapest_edits(codes) == least_edits(rows), rows


def test_long_conversations_need_memory_in_proportion():
    codes = bytes(random.Random(1).choice([1, 2, 1 + 4, 2 + 8]) for _ in range(20_000))
    cost, audit = repair.cheapest_edits(codes)
    assert cost > 0 and len(audit.replace("I", "")) == len(codes)


def test_conversations_as_damaged(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    got = run(repair.damage(df))
    assert got == brute(damaged(rows))
    assert any("R" in r[7] for r in got) and any("I" in r[7] for r in got)


@pytest.mark.parametrize("repeat", [1, 3])
def test_odd_rows(spark, repeat):
    long = "x" * 70_000 + " y. " * 20_000
    rows = [(1, None, "user", "hi."), (1, None, None, None), (1, 2, "", "no role."), (1, 2, "tool", "x"), (1, 1, "system", "a\nb!"),
            (None, 0, "user", "lost."), (None, None, "assistant", long), (2, 5, "assistant", "\t\x0b "), (2, 5, "assistant", "ü?"),
            (3, -4, "admin", "é"), (3, 9, "unknown", "A."), (4, 1, None, "z")] * repeat
    df = spark.createDataFrame([(*r, "x", "x", False) for r in rows], SCHEMA)
    assert run(repair.damage(df)) == brute(damaged(rows))
    as_is = defaultdict(list)
    for c, t, role, text in rows:
        as_is[c].append((t, " " if role is None else role, " " if text is None else text))
    assert run(df) == brute(as_is)


def test_dropped_and_empty_conversations(spark):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    df = spark.createDataFrame([(c, 0, "user", "a.", "", "", True) for c in gone], SCHEMA)
    nothing = hashlib.sha256().hexdigest()
    assert run(repair.damage(df)) == sorted([(c, 0, 0, 0, 0, 0, 0, "", nothing) for c in gone], key=repr)
    assert run(repair.damage(df.limit(0))) == []


def test_repaired_rows_follow_the_pattern(spark):
    df = repair.damage(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"))
    said = defaultdict(list)
    for r in repair.repair(df, repair.audit(df)).orderBy("conv_id", "position").collect():
        said[r.conv_id].append(r.role[:1])
    assert said and all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in said.values())
