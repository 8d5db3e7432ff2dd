import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

SMOKE = entry.SMOKE_DIR
needs_data = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="no driver data")


def test_every_oracle_has_a_query():
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries)
    assert not [n for n in set(queries) - set(oracle) if not n.startswith("op") and n != "pipeline"]


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_entry_without_the_optional_folders(tmp_path, pipeline_stays):
    top = Path(entry.__file__).resolve().parent
    gone = ["llm", "__pycache__"] + ([] if pipeline_stays else ["corpus_pipeline.py"])
    for name in ("berthline", "__spark_entry__.py", "corpus_pipeline.py"):
        if name in gone or not (top / name).exists():
            continue
        if (top / name).is_dir():
            shutil.copytree(top / name, tmp_path / name, ignore=shutil.ignore_patterns(*gone))
        else:
            shutil.copy(top / name, tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') or n == 'pipeline' for n in e.queries()))"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    queries, oracle, optional = said.stdout.split()
    assert int(queries) == int(oracle) > 80 and optional == "False"


@needs_data
def test_flagship(spark):
    report = entry.entry(spark)
    assert report.count() > 0 and "gmv_monthly_man" in report.columns


@needs_data
@pytest.mark.parametrize("name", ["entity_staged", "unified_ships", "metrics_document"])
def test_smoke(spark, name):
    assert entry.queries()[name](spark, SMOKE).count() > 0


@needs_data
def test_reports_read_their_tables_once(spark):
    """The stored days and months are what the parts of the document start from."""
    from berthline.plans import report
    from berthline.session import scratch_dir
    from berthline.workloads.fixtures import Tables
    from berthline.workloads.metric_queries import AS_OF

    t = Tables(spark, SMOKE)
    kpi, months, ads = report.choose_plan(t.daily_metrics, AS_OF, t.ad_daily, scratch=scratch_dir(spark, "plan"))
    doc = report.metrics_document(kpi, months, ads, report.channel_share(months), AS_OF, "x")
    plan = doc._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan and "orders" not in plan
    assert len(kpi.inputFiles()) and all("/days/" in f for f in kpi.inputFiles())


@needs_data
def test_shares_read_their_counts_once(spark):
    from conftest import plan_of

    from berthline.operators.rollups import share_top_k, value_counts
    from berthline.workloads.fixtures import Tables

    table = Tables(spark, SMOKE).table("pages")
    assert plan_of(share_top_k(value_counts(table, "url"), 3)).split("Initial Plan")[-1].count("FileScan") == 1


@needs_data
def test_all_written_dates_are_read_back(spark):
    from berthline.workloads.fixtures import Tables

    written = Tables(spark, SMOKE).seat_listing.filter("fishing_date is not null")
    want = sorted((r["ord"], str(r["fishing_date"])) for r in written.select("ord", "fishing_date").collect())
    read = [run(spark, SMOKE) for name, run in entry.queries().items() if name.startswith("daily_docs_") and name.endswith("round_trip")]
    assert len({d for _, d in want}) > 2
    assert any(sorted((r["ord"], r["fishing_date"]) for r in df.collect()) == want for df in read)
