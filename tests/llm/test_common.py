import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]

CODE = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from tessella.llm import common
df = common.stored(spark.range(5), "t")
assert df.count() == 5 and common.stored(df, "t").count() == 5
print("FOLDER", common.scratch_dir(spark))
"""


def test_scratch_without_a_configured_folder_is_made_and_deleted(tmp_path):
    """A session that no configuration file gives a checkpoint folder; what it stored is gone when it ends."""
    (tmp_path / "conf").mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "TMPDIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, env=env, capture_output=True, text=True, timeout=200)
    assert done.returncode == 0, done.stderr[-2000:]
    folder = done.stdout.split("FOLDER ")[1].strip()
    assert folder.startswith(str(tmp_path)) and not Path(folder).exists()


def test_discard(spark):
    from tessella.llm import common

    df = common.stored(spark.range(3), "t")
    path = df.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert Path(path).exists()
    common.discard(df)
    assert not Path(path).exists()
