import duckdb

from tessella.operators import metrics
from tessella.plans import oracles, queries

SF = "/root/testdata/sf0.01"


def test_recall_curve_retrieves_up_to_its_largest_k(spark):
    """Equal to its SQL, which cuts at the largest k that is reported."""
    got = sorted((r.k, r.hits, r.truths, r.recall) for r in queries.recall_curve(spark, SF).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = oracles.ORACLE_SQL["recall_curve"]
    assert f"rank <= {max(metrics.KS)})" in sql
    assert got == sorted(con.sql(sql).fetchall()) and [r[0] for r in got] == list(metrics.KS)


def test_records_cover_whole_texts(spark):
    """A change anywhere in a text can change its record; the order of its words cannot."""
    from tessella.plans import linkage

    words = [f"w{'x' * (i % 7)}{i}" for i in range(300)]
    texts = [" ".join(words), " ".join(reversed(words)), " ".join(words[:-1] + ["averyverylongword"])]
    import tempfile

    path = tempfile.mkdtemp()
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.mode("overwrite").parquet(f"{path}/documents.parquet")
    rows = {r.entity_id[3:]: (r.business_name, r.business_address) for r in linkage.document_view(spark, path).collect()}
    assert rows["0"] == rows["1"] != rows["2"] and rows["2"][0].startswith("averyverylongword ")
    assert len(rows["0"][0].split()) == 4 and len(rows["0"][1].split()) == 8
