import datetime as dt
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from berthline.operators import listing as L
from berthline.operators.page_index import PageIndex
from berthline.sinks.documents import write_daily_docs, write_manifest
from berthline.sources.landed import load_manifest, manifest_paths


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    names = ["만선호", "a", "B", "b", "", None, "hot"]
    data = [(i, rng.choice(names) if i % 3 else "hot", dt.date(2026, 4, rng.randrange(1, 9)) if i % 11 else None, rng.choice([0, 5, None])) for i in range(730)]
    return spark.createDataFrame(data, "ord int, ship_name string, fishing_date date, remain_seats int")


@pytest.mark.parametrize(("col", "asc"), [("fishing_date", True), ("ship_name", False), ("ship_name", True), ("remain_seats", False)])
def test_pages_equal_the_sorted_listing(spark, rows, tmp_path, col, asc):
    index = PageIndex.build(rows, str(tmp_path / "i"), col, asc, ["ord"], range_rows=90)
    assert index.rows == 730 and len(index.counts) > 4 and index.page_count() == 15
    for page, size in ((1, 50), (8, 50), (15, 50), (16, 50), (0, 50), (1, 1000), (2, 400), (730, 1)):
        want = [tuple(r) for r in L.sort_page(rows, col, asc, page, size, ["ord"]).collect()]
        assert [tuple(r) for r in index.page(page, size).collect()] == want
    again = PageIndex(spark, str(tmp_path / "i"))
    assert again.page(7).columns == rows.columns and again.page(7).collect() == index.page(7).collect()


def test_a_deep_page_reads_one_or_two_ranges(spark, rows, tmp_path):
    index = PageIndex.build(rows, str(tmp_path / "i"), "fishing_date", True, ["ord"], range_rows=60)
    for page in (1, 6, 14):
        plan = plan_of(index.page(page))
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "range_no" in filters and filters.count(",") <= 2, filters
    with pytest.raises(ValueError, match="sort by"):
        PageIndex.build(rows, str(tmp_path / "x"), "ord")


def test_empty_listing(spark, rows, tmp_path):
    index = PageIndex.build(rows.filter("false"), str(tmp_path / "i"), ties=["ord"])
    assert index.rows == index.page_count() == 0 and index.page().count() == 0


def test_a_manifest_names_what_is_read(spark, rows, tmp_path):
    root, manifest = str(tmp_path / "docs"), str(tmp_path / "manifest")
    write_daily_docs(rows.filter("fishing_date <> '2026-04-03'"), root, "fishing_date")
    write_manifest(rows, manifest, "now", date="fishing_date", boat="remain_seats")

    def read(*args, **how):
        df = load_manifest(spark, root, manifest, *args, **how)
        got = sorted((r.date, r.ord) for r in df.select("date", F.variant_get("rec", "$.ord", "int").alias("ord")).collect())
        return got, {f.split("date=")[1].split("/")[0] for f in df.inputFiles()}

    told = sorted((str(r.fishing_date), r.ord) for r in rows.filter("fishing_date is not null").collect())
    assert read() == ([t for t in told if t[0] != "2026-04-03"], {f"2026-04-0{d}" for d in range(1, 9) if d != 3})
    assert read("latest") == ([t for t in told if t[0] == "2026-04-08"], {"2026-04-08"})
    three = [dt.date(2026, 4, 1), "2026-04-03", "2026-04-05", "1999-01-01"]
    assert read(dates=three) == ([t for t in told if t[0] in ("2026-04-01", "2026-04-05")], {"2026-04-01", "2026-04-05"})
    assert manifest_paths(spark, root, manifest, dates=three) == ([f"{root}/date=2026-04-01", f"{root}/date=2026-04-05"], ["2026-04-03"])
    assert load_manifest(spark, root, manifest, dates=[]).count() == 0
