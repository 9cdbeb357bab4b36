import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_imports_without_the_corpus_operators():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('tessella.llm', 'corpus_pipeline')): raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 30 and 'pipeline' not in e.queries() and set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["normalize_text", "tfidf_weights", "adaptive_prune", "resolve_one_to_one", "grid_search", "profile_truth", "validate_output", "country_thresholds", "training_set", "assembled_files", "transliterate_names", "prune_sweep"])
def test_same_as_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(entry.oracle_sql()[name])
    columns = sorted(want.columns)
    got = entry.queries()[name](spark, sf)
    assert sorted(got.columns) == columns
    clean = lambda r: tuple(round(x, 5) if isinstance(x, float) else str(x) for x in r)
    a = sorted((clean(r) for r in got.select(*columns).collect()), key=str)
    b = sorted((clean(r) for r in want.select(", ".join(f'"{c}"' for c in columns)).fetchall()), key=str)
    assert a == b
