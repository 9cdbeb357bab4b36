import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from test_quality import brute  # noqa: E402
from test_shingles import brute_heads  # noqa: E402

from tessella.llm import pii, quality  # noqa: E402


def test_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        after = stage(spark, docs, sf)
        rows = after.collect()
        kept = {r.doc_id: r for r in rows}
        if name == "quality_rules":
            verdict = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
            assert set(kept) == {i for i, k in verdict.items() if k}
            assert not any(brute(r.text)[-1] for r in rows)
        if name == "near_duplicates":
            # Exact similarity of five-word shingles, 0.8 or more.
            assert set(kept) == brute_heads([(r.doc_id, r.text) for r in before]) and len(rows) == len(kept) < len(before)
        if name == "personal_data":
            assert len(rows) == len(before)
            assert pii.find(after).where("n_email + n_ip + n_card + n_phone > 0").count() == 0
            assert all(len(r.text) == r.n_chars for r in rows)
        if name == "mixture":
            assert 0.5 * len(before) < len(rows) < len(before)
        if name == "packed":
            assert sorted(kept) == sorted(r.doc_id for r in before) and after.columns[:5] == columns
        else:
            assert after.columns == columns
        docs = spark.createDataFrame(rows, after.schema)
    assert [r.doc_id for r in corpus_pipeline.run(spark, sf).orderBy("doc_id").collect()] == sorted(r.doc_id for r in docs.collect())


def through(spark, docs, path):
    docs.write.parquet(f"{path}/documents.parquet")
    return corpus_pipeline.run(spark, str(path)).collect()


def test_odd_rows_go_through_all_stages(spark, odd_docs, no_docs, tmp_path):
    """Nulls, empty and very long texts, repeated rows and clashing columns; then no rows at all."""
    good = [(i, f"{i} rows of words that differ from one another by number {i * 7919 % 1000} and by {i * 31} more", "en", "s", 80) for i in range(100, 130)]
    more = spark.createDataFrame(good + good[:3] + [(None, "a text without an id but with enough different words to pass all rules", None, None, None)], no_docs.schema)
    rows = through(spark, odd_docs.unionByName(more, allowMissingColumns=True), tmp_path / "odd")
    ids = [r.doc_id for r in rows]
    assert set(ids) <= {None, 8, *range(100, 130)} and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    assert {1, 2, 3, 4, 5, 6, 7}.isdisjoint(ids) and all(r.batch_id for r in rows)
    assert through(spark, no_docs, tmp_path / "none") == []
