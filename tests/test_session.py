import os
import subprocess
import sys
from pathlib import Path

import pytest

from berthline import session

REPO = str(Path(__file__).resolve().parent.parent)

# A session of which nothing says where scratch space is.
BARE = """
from pyspark.sql import SparkSession
from berthline.session import scratch_dir, stored
spark = SparkSession.builder.master("MASTER").config("spark.ui.enabled", "false").config("spark.executor.memory", "600m").config("spark.sql.warehouse.dir", "HERE/tables").getOrCreate()
paths = [scratch_dir(spark, "a") for _ in range(2)]
print("found", paths[0] != paths[1], stored(spark.range(5), paths[0]).count(), "/tables/" in paths[0], len({p.rpartition("/")[0] for p in paths}))
"""


@pytest.mark.parametrize(("master", "in_warehouse"), [("local[2]", False), ("local-cluster[2,1,1024]", True)])
def test_scratch_space_without_a_checkpoint_folder(tmp_path, master, in_warehouse):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": REPO, "TMPDIR": str(tmp_path)}
    code = BARE.replace("MASTER", master).replace("HERE", str(tmp_path))
    ran = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=200)
    assert f"found True 5 {in_warehouse} 1" in ran.stdout, ran.stderr[-2000:]


def test_local_paths_off_a_local_master_are_tried(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    session._reaches_all.cache_clear()
    path = session.scratch_dir(spark, "x")
    assert session.stored(spark.range(3), path).count() == 3
    monkeypatch.setattr(session, "_reaches_all", lambda *_: False)
    with pytest.raises(ValueError, match="do not share"):
        session.scratch_dir(spark, "x")
