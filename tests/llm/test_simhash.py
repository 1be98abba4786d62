import random
from collections import defaultdict

import pytest
import xxhash

from clickspark.llm import simhash
from clickspark.llm.components import connected_components
from llm_data import SF_SMALL, docs, none, odd  # noqa: F401


def fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in lower.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
    if not w:
        return 0
    g = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(links, nodes):
    of = {n: n for n in nodes}

    def root(x):
        while of[x] != x:
            x = of[x]
        return x
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        of[b] = a
    return {n: root(n) for n in nodes}


def brute(rows):
    fps = [(i, fingerprint(t)) for i, t in rows]
    distinct = sorted({f for _, f in fps})
    links = [(a, b) for k, a in enumerate(distinct) for b in distinct[k + 1:] if (a ^ b).bit_count() <= 2]
    of = components(links, distinct)
    least = defaultdict(list)
    for i, f in fps:
        if i is not None:
            least[of[f]].append(i)
    return sorted(((i, f"{f:016x}", min(least[of[f]], default=None)) for i, f in fps), key=repr)


def run(df, **more):
    return sorted(map(tuple, simhash.simhash_groups(df, **more).select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_matches_brute_force_on_documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert run(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_odd_rows_and_block_borders(odd, none, monkeypatch):
    assert run(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert run(none) == []
    long = " ".join(f"w{i * 7 % 1013}" for i in range(5000))
    whole = simhash.simhash(long)
    blocks = simhash.word_blocks
    monkeypatch.setattr(simhash, "word_blocks", lambda data: blocks(data, 37))
    assert simhash.simhash(long) == whole
    assert simhash.simhash("a  b") == simhash.simhash("A b")


def test_stands_marks_one_row_of_each_group(odd):
    rows = simhash.simhash_groups(odd.where("doc_id is null or doc_id != 7")).collect()    # 7 heads two groups
    by = defaultdict(set)
    for r in rows:
        if r.stands:
            by[r.component_id].add((r.doc_id, r.text_hash))
    assert {len(v) for v in by.values()} == {1}
    assert set(by) == {r.component_id for r in rows}


def signed(x):
    return x - (1 << 64) * (x >> 63)


@pytest.mark.parametrize(("dense", "bits"), [(128, 2), (3, 2), (0, 2), (3, 1), (0, 0)])
def test_links_equal_all_pairs(spark, dense, bits):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1, 1 << 63]
    fps = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (1 << 64) - 1 for c in centres for _ in range(25)} | set(centres)
    fps = sorted(f & (1 << 64) - 1 for f in fps)
    links = [(r.a, r.b) for r in simhash.fingerprint_links(
        spark.createDataFrame([(signed(f),) for f in fps], "fp long"), bits, dense).collect()]
    value = {signed(f): f for f in fps}
    assert all((value[a] ^ value[b]).bit_count() <= bits for a, b in links)
    pairs = [(a, b) for k, a in enumerate(fps) for b in fps[k + 1:] if (a ^ b).bit_count() <= bits]
    assert components([(value[a], value[b]) for a, b in links], fps) == components(pairs, fps)
    if dense == 128:
        assert {tuple(sorted((value[a], value[b]))) for a, b in links} == set(pairs)


def test_components_of_a_path_a_star_and_nothing(spark):
    n = 70
    path = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3), (1000, 1001)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(300)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
