"""The registered queries against their SQL, and the pipeline against its stages' definitions."""

import os
import sys

import pytest
from conftest import SF01

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from llm_cases import awkward  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402
from test_groups import plain_components, plain_lines  # noqa: E402

from fundlake.llm import mixing, packing, quality  # noqa: E402
from fundlake.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    result = compare(spark, duck(SF01), name, QUERIES[name], ORACLE_SQL[name], SF01)
    assert result["match"], result


def test_every_operator_and_the_pipeline_are_registered():
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and {"pipeline", *QUERIES} <= names
    assert "pipeline" not in __spark_entry__.oracle_sql()


def test_stages_decide_on_what_is_left(spark):
    """Each stage's rows against its definition on its own input."""
    from fundlake.llm.common import staged, table
    docs = table(spark, SF01, "documents")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(staged(stage(spark, steps[-1], SF01), "test"))
    rows = [[r.asDict() for r in s.collect()] for s in steps]
    assert all(s.columns == docs.columns for s in steps[:-1])
    good, lines, near, mixed, packed = rows[1:]
    whole = {r["doc_id"]: r for r in rows[0]}
    assert all(r == whole[r["doc_id"]] for r in good)
    scored = {r.doc_id: r.predicted for r in quality.score(docs, quality.fit(docs, table(spark, SF01, "labels"))).collect()}
    assert {r["doc_id"] for r in good} == {i for i, p in scored.items() if p}
    want = {i: t for i, _, _, t in plain_lines([(r["doc_id"], r["text"]) for r in good])}
    assert {r["doc_id"]: r["text"] for r in lines} == want and all(r["n_chars"] == len(r["text"]) for r in lines)
    groups = plain_components([(r["doc_id"], r["text"]) for r in lines])
    assert sorted(r["doc_id"] for r in near) == sorted(i for i, (_, c) in groups.items() if i == c)
    chosen = {r.doc_id for r in mixing.calibrated(steps[3]).collect() if r.selected}
    assert {r["doc_id"] for r in mixed} == chosen
    totals = {r["doc_id"]: r["doc_tokens"] for r in packed}
    assert set(totals) == chosen and sum(r["length"] for r in packed) == sum(totals.values())
    assert all(sum(packing.piece_lengths(n)) == n for n in totals.values())


def test_stages_take_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SF01)
        out.write.parquet(str(tmp_path / name))
        if stage is not corpus_pipeline.pack_stage:
            assert out.columns == docs.columns
    assert corpus_pipeline.quality_stage(spark, docs, SF01).count() <= 14
