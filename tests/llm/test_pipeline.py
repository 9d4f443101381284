"""The pipeline's stages on a small corpus with known cases."""

import random

import corpus_pipeline
from stationlens.llm.shared import table

from .test_matching import linked


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    rng = random.Random(1)
    benchmark = [r.text for r in table(spark, sf, "benchmark").limit(3).collect()]
    first = docs.where("lang = 'en' and n_chars > 1500").limit(3).collect()
    planted = [(90_000, first[0].text, "en", "p", 1), (90_001, first[1].text.replace(" the ", " a ", 2), "en", "p", 1), (90_002, " ".join(rng.choice(first[2].text.split()) for _ in range(50)) + " " + benchmark[0], "en", "p", 1), (90_003, None, "en", "p", 1), (90_004, "1234 5678", "en", "p", 1)]
    now = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, corpus_pipeline.materialize(stage(spark, now, sf), name)
        assert now.schema.simpleString() == docs.schema.simpleString()
        left.append({r.doc_id for r in now.collect()})
        if name == "near_dedup":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert left[-1] == {c for _, _, c in linked(rows, 5, 80)}
    assert not {90_003, 90_004} & left[0] and {90_000, 90_001, 90_002} <= left[0] and len(left[0]) > 190
    assert 90_002 in left[2] and 90_002 not in left[3] and 90_000 not in left[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert {r.doc_id for r in packed.collect()} == left[3]


def test_empty(spark, sf):
    now = table(spark, sf, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.materialize(stage(spark, now, sf), "empty")
    assert now.count() == 0


def test_rows_that_repeat(spark, sf):
    docs = table(spark, sf, "documents").limit(20)
    twice = docs.unionByName(docs)
    left = corpus_pipeline.near_dedup(spark, twice, sf).collect()
    assert len(left) == len({r.doc_id for r in left})


def test_rows_without_an_id_of_their_own(spark, sf):
    docs = table(spark, sf, "documents").limit(0)
    rng = random.Random(2)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    a, b, c, d, e = (" ".join(words(80)) for _ in range(5))
    passage = next(r.text for r in table(spark, sf, "benchmark").collect() if len((r.text or "").split()) > 20)
    rows = [(1, a), (5, a + " end"), (5, b), (6, c), (6, d), (None, c + " end"), (None, e), (None, e), (7, e + " end"), (None, passage), (8, passage), (8, " ".join(words(90)))]
    docs = spark.createDataFrame([(i, t, "en", "p", len(t)) for i, t in rows], docs.schema)
    left = corpus_pipeline.materialize(corpus_pipeline.near_dedup(spark, docs, sf), "left")
    got = sorted([(r.doc_id, r.text) for r in left.collect()], key=repr)
    assert got == sorted([(1, a), (5, b), (6, c), (6, d), (7, e + " end"), (8, passage), rows[-1]], key=repr)
    got = corpus_pipeline.decontaminated(spark, docs, sf).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=repr) == sorted([r for r in rows if r[1] != passage], key=repr)
