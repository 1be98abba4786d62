import corpus_pipeline
import pytest
from clickspark.llm import quality
from llm_data import SF_SMALL, docs, none  # noqa: F401

MENU = "\n".join(" ".join(f"menu{i}x{j}" for j in range(40)) for i in range(5))


LONG_LINE = " ".join(f"menu{j}" for j in range(40))


def own(host, i):
    return "\n".join(" ".join(f"{host}{i}line{k}x{j}" for j in range(20)) for k in range(3))


@pytest.mark.parametrize(("size", "planted"), [(10, 4), (10, 10), (50, 4), (500, 11), (500, 40), (3000, 51), (3000, 500)])
def test_planted_boilerplate_goes_at_every_host_size(spark, docs, size, planted):
    host = f"h{size}"
    rows = [(i, f"{MENU}\n{own(host, i)}" if i < planted else own(host, i), None, host) for i in range(size)]
    rows += [(10_000 + i, own(host, size - 1) if planted < size else MENU, None, host) for i in range(60)]
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs(rows, extra=False), "").collect()}
    assert not kept & set(range(planted))
    assert kept >= set(range(planted, size))
    assert planted == size or kept >= set(range(10_000, 10_060))        # copies count once


def test_lines_at_or_below_the_threshold_stay(spark, docs):
    rows = [(1000 * size + i, f"{MENU}\n{own(f'h{size}', i)}" if i < n else own(f"h{size}", i), None, f"h{size}")
            for size, n in ((10, 3), (500, 10), (3000, 24)) for i in range(size)]
    assert corpus_pipeline.quality_rules(spark, docs(rows, extra=False), "").count() == len(rows)


def test_threshold_of_a_host_with_a_million_texts(spark):
    """448 texts with the menu go, 447 stay: the texts of the host are short, but all different."""
    for planted, stays in ((447, True), (448, False)):
        rows = spark.range(1_000_000).selectExpr("id as doc_id", f"if(id < {planted}, concat('{LONG_LINE}\\n', concat('o', id)), concat('o', id)) as text",
                                                 "'big' as source")
        got = quality.quality_rules(rows, min_words=0).where(f"doc_id < {planted} and not base_failed").agg({"line_removed": "max"}).first()[0]
        assert (got == 0 or got is None) is stays
