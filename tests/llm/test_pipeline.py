"""The stages one by one on their predecessor's rows, against brute-force versions."""

from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import decontamination, language_id
from tests.llm.conftest import ODD
from tests.llm.test_operators import components_by_force, hits_by_force, lines_by_force

SF = "/root/testdata/sf0.001"


def test_stages(llm, tmp_path):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs_out = stage(llm, docs, SF)
        docs_out.write.parquet(f"{tmp_path}/{name}")
        out = llm.read.parquet(f"{tmp_path}/{name}")
        texts = [(i, r.text) for i, r in before.items()]
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == set(before)
            break
        assert out.columns == columns and out.dtypes == docs.dtypes
        after = {r.doc_id: r for r in out.collect()}
        if name == "language":
            rejected = {r.doc_id for r in language_id.report(docs).where("rejected").collect()}
            assert set(after) == set(before) - rejected and len(after) > 0.95 * len(before)
        elif name == "line_dedup":
            assert {i: r.text for i, r in after.items()} == lines_by_force(texts)
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "near_duplicates":
            assert set(after) == {i for i, (_, c) in components_by_force(texts).items() if c == i}
        elif name == "decontamination":
            assert set(after) == {i for i, r in hits_by_force(texts, bench).items() if not r[4]}
        if name != "line_dedup":
            assert all(after[i] == before[i] for i in after)
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_odd_rows(llm, make):
    """Nulls, empty and long texts, repeated rows; columns named like those of the operators keep their values."""
    names = ("lang_pred", "rejected", "n_lines", "removed")
    for rows in (ODD, []):
        docs = make(rows).withColumns({c: F.lit(f"own {c}") for c in names})
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(llm, docs, SF)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            kept = out.collect()
            assert all(r["score"] == "mine" and all(r[c] == f"own {c}" for c in names) for r in kept)
            if name == "line_dedup":
                assert len(kept) == len(rows)
                assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted((i or 0, t or "") for i, t in rows)
        assert (corpus_pipeline.packed(llm, docs, SF).count() > 0) == bool(rows)


def test_contamination_rule():
    assert decontamination.WINDOW == 13


def test_run(llm):
    out = corpus_pipeline.run(llm, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0
