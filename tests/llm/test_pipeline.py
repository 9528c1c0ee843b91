"""The pipeline's stages in a chain against brute force, on the smallest tables; and the queries against their SQL."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_whole import brute_components
from tests.test_entry import same
from variantloom.llm import queries
from variantloom.llm.common import stash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, name):
    same(spark, queries.QUERIES[name], queries.ORACLES[name])


def test_stages(spark):
    docs = queries.table(spark, SF, "documents")
    plain = lambda df: [(r.doc_id, r.text, r.source) for r in df.collect()]
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stash(stage(spark, tables[-1], SF), "stage"))
    good, single, apart, mixed, packed = tables[1:]
    assert all(t.columns == docs.columns for t in tables[:-1])
    verdict = {r.doc_id: r.predicted for r in queries.op10_quality_classifier(spark, SF).collect()}
    assert {r[0] for r in plain(good)} == {i for i, p in verdict.items() if p}
    best = {}
    for i, t, _ in plain(good):
        key = "".join(c for c in t if c not in " \t\n\x0b\f\r")
        best[key] = max(best.get(key, (-1, 0)), (len(t), -i))
    assert Counter(i for i, _, _ in plain(single)) == Counter(-i for _, i in best.values())
    links = brute_components([r[:2] for r in plain(single)], 5, 80)
    assert Counter(r[0] for r in plain(apart)) == Counter(i for i, n, c in links if n == 0 or i == c)
    times = Counter(i for i, _, _ in plain(mixed))
    assert max(times.values()) <= 3 and set(times) <= {r[0] for r in plain(apart)}
    ends = Counter(r.doc_id for r in packed.collect() if r.start == 0)
    assert ends == times
    assert corpus_pipeline.run(spark, SF).count() == packed.count()
