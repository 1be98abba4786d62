import re
from collections import Counter, defaultdict

from clickspark.llm import quality
from llm_data import SF_MID, docs, none, odd  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    w = WORD.findall(t)
    g = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {p for i in range(len(w) - 2) if g[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def brute(rows, min_docs=quality.MIN_DOCS, growth=quality.GROWTH, min_left=quality.MIN_LEFT, min_words=quality.MIN_WORDS):
    norm = lambda t: [x for x in (re.sub("[ \t\x0b\x0c\r]+", " ", y).strip(" ") for y in re.sub(
        "[A-Z]", lambda m: m[0].lower(), t or "").split("\n")) if x]
    texts = defaultdict(set)
    for _, t, host in rows:
        texts[host].add(re.sub(" ?\n ?", "\n", re.sub("[ \t\x0b\x0c\r]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))))
    n = Counter((h, x) for h, ts in texts.items() for t in ts for x in set(norm(t)))
    out = []
    for i, t, h in rows:
        b = base(t)
        lines = set(norm(t))
        words = lambda xs: sum(len(x.split(" ")) for x in xs)
        gone = words(x for x in lines if n[h, x] > min_docs and n[h, x] ** 2 > growth * len(texts[h]))
        failed = b[0] < min_words or 100 * b[4] > 50 * b[0]
        out.append((i, h, *b, words(lines), gone, failed, not failed and words(lines) - gone >= min_left * words(lines)))
    return sorted(out, key=repr)


def run(df, **limits):
    cols = ["doc_id", "source", *quality.BASE, "line_total", "line_removed", "base_failed", "kept"]
    return sorted(map(tuple, quality.quality_rules(df, **limits).select(*cols).collect()), key=repr)


def test_matches_brute_force_on_documents(spark):
    df = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    got = run(df)
    assert got == brute(rows) and any(r[8] for r in got)        # the rule of the query removes lines here
    limits = {"min_docs": 1, "growth": 0.1, "min_left": 0.9}
    got = run(df, **limits)
    assert got == brute(rows, **limits)
    assert any(not r[-1] and not r[-2] for r in got)


def test_depleted_documents_go_and_copies_count_once(docs):
    own = lambda i: " ".join(f"own{i}x{j}" for j in range(60))
    menu = "\n".join(" ".join(f"menu{i}x{j}" for j in range(40)) for i in range(5))
    rows = [(i, f"{menu}\n{own(i)}", None, "a") for i in range(8)] + [(100 + i, own(999), None, "a") for i in range(30)]
    got = {r[0]: r[-1] for r in run(docs(rows), min_docs=5)}
    assert not any(got[i] for i in range(8)) and all(got[100 + i] for i in range(30))


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    limits = {"min_docs": 0, "growth": 0.0, "min_words": 1}
    assert run(odd, **limits) == brute(rows, **limits)
    assert run(none) == []
