import datetime as dt
import json
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from berthline import dims
from berthline import fixed_values as fv
from berthline.operators.rollups import days_ahead
from berthline.plans import availability as A
from berthline.plans import report as R
from berthline.schemas import SEAT_COLUMNS, SEAT_ROW
from berthline.sinks import documents as S
from berthline.sinks import tables as T
from berthline.sources.landed import NO_JSON, explode_landed, load_daily_docs, payload_lines, read_payload
from berthline.streaming import incremental as X

DAY = dt.date(2026, 4, 1)
TS = dt.datetime(2026, 4, 1, 1, 0)


def seat(spark, *rows):
    """(ord, name, date, collected hour, remain) to snapshot rows with ord."""
    data = [
        (TS + dt.timedelta(hours=h), n, "a", "p", d, "05:30", "", "x", "", "", 0, 0, r, "ING", "", "1", o)
        for o, n, d, h, r in rows
    ]
    return spark.createDataFrame(data, _with_ord())


def _with_ord():
    from pyspark.sql import types as t

    return t.StructType([*SEAT_ROW.fields, t.StructField("ord", t.IntegerType())])


def state(df):
    return {(r.ship_name, r.fishing_date): r.remain_seats for r in df.collect()}


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "seats")
    next_day = dt.date(2026, 4, 2)
    T.upsert(path, seat(spark, (1, "a", DAY, 0, 1), (2, "a", DAY, 0, 2), (3, "b", None, 0, 3), (4, "c", next_day, 0, 4)))
    want = {("a", DAY): 2, ("b", None): 3, ("c", next_day): 4}
    assert state(T.read_seats(spark, path)) == want
    again = seat(spark, (1, "b", None, 1, 9), (2, "d", DAY, 1, 5))
    for _ in range(2):
        T.upsert(path, again)
        assert state(T.read_seats(spark, path)) == want | {("b", None): 9, ("d", DAY): 5}
    late = seat(spark, (9, "a", DAY, -1, 7))
    T.upsert(path, late)
    assert state(T.read_seats(spark, path))[("a", DAY)] == 2
    T.upsert(path, late, guard_late=False)
    assert state(T.read_seats(spark, path))[("a", DAY)] == 7


def test_upsert_failure_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "seats")
    T.upsert(path, seat(spark, (1, "a", DAY, 0, 1)))
    bad = seat(spark, (1, "a", DAY, 1, 2)).withColumn(
        "remain_seats", F.raise_error(F.lit("broken")).cast("bigint")
    )
    with pytest.raises(Exception, match="broken"):
        T.upsert(path, bad)
    assert state(T.read_seats(spark, path)) == {("a", DAY): 1}


def test_only_touched_dates_are_read(spark, tmp_path):
    path = str(tmp_path / "seats")
    other = dt.date(2026, 5, 1)
    T.upsert(path, seat(spark, (1, "a", DAY, 0, 1), (2, "b", None, 0, 2), (3, "c", other, 0, 3)))
    T.upsert(path, seat(spark, (1, "a", DAY, 1, 5), (2, "b", None, 1, 6)))
    assert state(T.read_seats(spark, path)) == {("a", DAY): 5, ("b", None): 6, ("c", other): 3}
    batch = seat(spark, (1, "a", DAY, 1, 5))
    touched = T._touched(T.read_seats(spark, path), batch)
    assert {(r.ship_name, r.fishing_date) for r in touched.collect()} == {("a", DAY)}
    assert "dynamicpruning" in touched._jdf.queryExecution().executedPlan().toString()


def test_history_and_refresh(spark, tmp_path):
    path = str(tmp_path / "h")
    assert T.read_history(spark, path).count() == 0
    T.append_history(spark, path, TS, "1", 5, note="n" * 300)
    T.append_history(spark, path, TS, "2", 0, fv.RUN_FAILED)
    rows = T.read_history(spark, path).orderBy("batch_id").collect()
    assert [(r.row_count, r.status, len(r.note)) for r in rows] == [(5, fv.RUN_OK, 300), (0, fv.RUN_FAILED, 0)]
    table = str(tmp_path / "t")
    T.full_refresh(spark.range(3), table)
    T.full_refresh(T.read_refreshed(spark, table).filter("id > 0"), table)
    assert sorted(r.id for r in T.read_refreshed(spark, table).collect()) == [1, 2]


@pytest.fixture
def ships(spark):
    rows = [(i, f"s{i}", "2026-04-01" if i < 7 else "2026-04-02", 5 if i % 2 else None) for i in range(9)]
    rows.append((9, "s9", None, 1))
    return spark.createDataFrame(rows, "ord int, ship_name string, sdate string, ship_no bigint")


def test_daily_documents(spark, tmp_path, ships):
    docs = {}
    for r in S.daily_docs(ships).collect():
        docs.setdefault(r.date, []).append(json.loads(r.value))
    assert sorted(s["ship_name"] for s in docs["2026-04-01"]) == [f"s{i}" for i in range(7)]
    assert docs["2026-04-01"][0]["ship_no"] is None and set(docs) == {"2026-04-01", "2026-04-02"}
    S.write_daily_docs(ships, str(tmp_path / "d"))
    name = F.variant_get("rec", "$.ship_name", "string").alias("name")
    read = load_daily_docs(spark, str(tmp_path / "d"), ["2026-04-01"]).select(name).collect()
    assert {r.name for r in read} == {f"s{i}" for i in range(7)} and len(read) == 7


def test_manifest(ships, spark, tmp_path):
    manifest = json.loads(S.build_manifest(ships, "now").first().value)
    assert manifest["updated_at"] == "now"
    assert manifest["dates"][0] == {"date": "2026-04-01", "total": 7, "af_matched": 3}
    S.write_manifest(ships, str(tmp_path / "m"), "now")
    assert json.loads(spark.read.text(str(tmp_path / "m")).first().value) == manifest


def test_payload_round_trip(spark, tmp_path):
    rows = seat(spark, *[(i, f'배 "{i}"', DAY if i else None, 0, i) for i in range(40)])
    path = str(tmp_path / "p")
    assert S.write_payload(rows.repartition(5), path, "now", order=["ord"]) == 40
    text = S.payload_document(spark, path).first().value
    S.payload_document(spark, path).write.text(f"{path}/document")
    doc = json.loads(text)
    assert (doc["updated_at"], doc["row_count"]) == ("now", 40)
    assert [r[12] for r in doc["rows"]] == list(range(40))
    assert doc["rows"][0][4] is None and doc["rows"][1][4] == "2026-04-01"
    assert "배" in text and len(doc["rows"][0]) == len(SEAT_COLUMNS)
    back = read_payload(spark, f"{path}/document")
    assert {(r.ship_name, r.remain_seats) for r in back.collect()} == {
        (f'배 "{i}"', i) for i in range(40)
    }
    assert payload_lines(spark.read.text(f"{path}/rows")).count() == 40


def test_payload_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = seat(spark, *[(i, f"s{i}", DAY, 0, i) for i in range(30)])
    for part, size in ((rows, 30), (rows.filter("ord < 3"), 3), (rows, 30)):
        assert S.write_payload(part.repartition(3), path, "now", order=["ord"]) == size
        doc = json.loads(S.payload_document(spark, path).first().value)
        assert doc["row_count"] == size and [r[12] for r in doc["rows"]] == list(range(size))


# --- report -------------------------------------------------------------------------


def _months(spark, *rows):
    schema = (
        "year_month string, gmv_man double, bookings bigint, cvr double, ships bigint, members bigint, naver_spend double, "
        "meta_spend double, google_spend double, total_ad_spend double, naver_conversions bigint, aov double, cac double"
    )
    return spark.createDataFrame(
        [(ym, 1.25, 2, 3.0, 4, 5, n, m, g, 0.0, 0, None, float("nan")) for ym, n, m, g in rows], schema
    )


def test_channel_share(spark):
    months = _months(spark, ("2026-01", 9.0, 9.0, 9.0), ("2026-02", 1.0, 1.0, 1.0))
    got = [(r.channel, r.spend, r.pct) for r in R.channel_share(months).orderBy("pos").collect()]
    assert got == [("Meta Ads", 1.0, 33.3), ("Google Ads", 1.0, 33.3), ("네이버 쇼핑", 1.0, 33.3)]
    empty = _months(spark, ("2026-01", 0.0, 0.0, 0.0))
    assert R.channel_share(empty).count() == 0
    assert [r.pct for r in R.channel_share(empty, strict=False).orderBy("pos").collect()] == [48, 28, 16, 8]
    assert R.channel_share(months.limit(0), strict=False).count() == 0


def test_document(spark, tmp_path):
    daily = spark.createDataFrame(
        [(DAY, D(10), 1, 1, None, 1, 1, D(1), D(1))],
        "date date, gmv decimal(18,2), bookings bigint, sessions bigint, cvr double, ships bigint, members bigint, "
        "ad_spend_meta decimal(18,2), ad_spend_google decimal(18,2)",
    )
    kpi, months, ads = R.choose_plan(daily, DAY)
    doc = R.metrics_document(kpi, months, ads, R.channel_share(months), DAY, "test")
    S.write_metrics(doc, str(tmp_path / "m"))
    got = json.loads(spark.read.text(str(tmp_path / "m")).first().value)
    assert list(got)[:3] == ["updated", "source", "kpi"] and not got["is_default"]
    assert got["kpi"]["report_date"] == "2026-04-01" and got["kpi"]["bookings"] == 1
    assert got["gmv_trend"][0]["label"] == "04월" and got["ship_trend"][0]["label"] == "2026-04"
    assert got["cac_trend"][0]["cac"] == 2.0 and got["naver"] == []
    assert [c["pct"] for c in got["channels"]] == [50.0, 50.0, 0.0]


def test_document_without_data(spark):
    kpi = spark.createDataFrame(
        [],
        "report_date string, gmv_man double, gmv_wow_pct double, bookings bigint, bookings_wow_pct double, cvr_pct double, "
        "ships bigint, members bigint, total_ad_spend double",
    )
    none = _months(spark, ("2026-01", 0.0, 0.0, 0.0)).limit(0)
    ads = spark.createDataFrame(
        [], "year_month string, impressions bigint, clicks bigint, conversions bigint, spend double, roas double"
    )

    def document(defaults=None):
        channels = R.channel_share(none)
        return R.metrics_document(kpi, none, ads, channels, DAY, "t", defaults=defaults).first()

    empty = document()
    assert empty.is_default and empty.kpi.bookings is None and empty.gmv_trend == []
    given = document(fv.DEFAULT_KPI)
    assert (given.kpi.gmv_man, given.kpi.ships, given.kpi.report_date) == (390.0, 765, "2026-04-01")


# --- pipelines ----------------------------------------------------------------------


def test_unified_ships(spark, tmp_path):
    def record(name, area, stime, no):
        ship = {"no": 1, "name": name, "area_sub": area, "lat": 1.0, "lng": 2.0}
        return {"ship": ship, "sdate": "2026-04-01", "stime": stime, "schedule_no": no, "price": 9}

    listed = [record("만선호", "태안", "05:30", "1"), record("만선호", "태안", "05:30", "1")]
    listed.append(record("nobody", "nowhere", "06:00", "2"))
    page = json.dumps({"total": 3, "list": listed})
    older = json.dumps({"total": 0, "list": [record("gone", "x", "07:00", "3")]})
    early = TS - dt.timedelta(days=2)
    landed = [(TS, DAY, 1, page), (early, DAY, 1, older), (TS, dt.date(2020, 1, 1), 1, page)]
    pages = spark.createDataFrame(landed, "run_ts timestamp_ntz, request_date date, page int, value string")
    directory = spark.createDataFrame(
        [
            (early, "252", "<title>old - x</title>[태안 레드호]st_uid=4&pa_uid=252"),
            (TS, "252", "<title>레드호 - x</title>[태안 레드호]st_uid=4&pa_uid=252"),
        ],
        "run_ts timestamp_ntz, directory_id string, html string",
    )
    cells = "".join(
        f"<td><span class='day'>{d}</span><span class='num'>{d}</span></td>" for d in (1, 2, 2, 30)
    )
    calendar = spark.createDataFrame(
        [("252", 2026, 4, cells)], "directory_id string, year int, month int, html string"
    )
    known = A.Dims(dims.entity_map(spark), dims.boat_coords(spark), scratch=str(tmp_path))
    spine = days_ahead(spark, DAY, 14)
    both = A.unified_ships(
        A.listing_ships(pages, known, spine=spine),
        A.calendar_listing(directory, calendar, known, DAY),
        spine,
    )
    got = {(r.ship_name, r.sdate, r.ship_no, r.area_main, r.lat, r.source) for r in both.collect()}
    assert got == {
        ("만선호", "2026-04-01", 64, "충남", 36.7456, fv.LISTING_SOURCE),
        ("nobody", "2026-04-01", None, "기타", 1.0, fv.LISTING_SOURCE),
        ("레드호", "2026-04-01", 342, "충남", 36.7456, fv.CALENDAR_SOURCE),
        ("레드호", "2026-04-02", 342, "충남", 36.7456, fv.CALENDAR_SOURCE),
    }
    assert both.count() == 4
    assert len(S.ships_to_payload(both, "now").columns) == 20


def test_incremental(spark, tmp_path):
    landing, target, state_dir = (str(tmp_path / n) for n in ("in", "seats", "state"))
    (tmp_path / "in").mkdir()

    def land(name, *rows):
        text = json.dumps([{"name": n, "sdate": "2026-04-01", "remain": r} for n, r in rows])
        (tmp_path / "in" / name).write_text(text, encoding="utf-8")

    def run():
        X.run_incremental(spark, landing, target, state_dir)
        return {r.ship_name: r.remain_seats for r in T.read_seats(spark, target).collect()}

    land("1.json", ("a", 1), ("a", 2), ("b", 3))
    assert run() == {"a": 2, "b": 3}
    assert run() == {"a": 2, "b": 3}
    land("2.json", ("b", 4), ("c", 5))
    (tmp_path / "in" / "3.json").write_text('[{"name":')
    assert run() == {"a": 2, "b": 4, "c": 5}
    done = T.read_history(spark, f"{state_dir}/history").filter(F.col("status") == fv.RUN_OK)
    assert sorted(r.note for r in done.collect()) == [
        "rows 2, after dedup 2, rejected 1",
        "rows 3, after dedup 2, rejected 0",
    ]
    rejects = spark.read.parquet(f"{state_dir}/rejects")
    assert [(r.reason, r.raw) for r in rejects.collect()] == [(NO_JSON, '[{"name":')]


def test_a_text_that_lands_again_changes_nothing(spark, tmp_path):
    landing, target, state_dir = (str(tmp_path / n) for n in ("in", "seats", "state"))
    (tmp_path / "in").mkdir()

    def land(name, remain):
        (tmp_path / "in" / name).write_text(json.dumps([{"name": "a", "sdate": "2026-04-01", "remain": remain}]))

    def run():
        X.run_incremental(spark, landing, target, state_dir, repeats_within="1 day")
        return [r.remain_seats for r in T.read_seats(spark, target).collect()], T.seats(spark, target).versions()

    land("1.json", 5)
    assert run() == ([5], [1])
    land("2.json", 4)
    assert run() == ([4], [1, 2])
    land("again.json", 5)
    assert run() == ([4], [1, 2])
    # an old file that was not seen before is not late
    land("3.json", 3)
    old = os.path.getmtime(tmp_path / "in" / "1.json") - 3 * 86400
    os.utime(tmp_path / "in" / "3.json", (old, old))
    X.run_incremental(spark, landing, target, state_dir, repeats_within="1 day")
    assert T.seats(spark, target).versions() == [1, 2, 3]
    done = T.read_history(spark, f"{state_dir}/history")
    assert done.count() == 3


def test_replayed_and_half_done_batches(spark, tmp_path):
    target, history, staging = (str(tmp_path / n) for n in ("seats", "history", "staging"))
    docs = spark.createDataFrame(
        [("f", TS, '[{"name":"a","sdate":"2026-04-01","remain":1}]')],
        "file string, landed_at timestamp, value string",
    )
    X.ingest_batch(docs, 0, target, history, staging)
    X.ingest_batch(docs.filter("false"), 0, target, history, staging)
    assert T.read_seats(spark, target).count() == 1
    # a batch that was written but not published is published from what was written
    assert explode_landed(docs).count() == 1
    table = T.seats(spark, target)
    table.write(seat(spark, (1, "z", DAY, 0, 8)).drop("ord"), "1-on-1")
    assert state(T.read_seats(spark, target)) == {("a", DAY): 1}
    X.ingest_batch(docs.filter("false"), 1, target, history, staging)
    assert state(T.read_seats(spark, target)) == {("z", DAY): 8}
    # published but not noted
    table.publish(table.write(seat(spark, (1, "z", DAY, 0, 9)).drop("ord")), 2, label="7")
    X.ingest_batch(docs, 7, target, history, staging)
    assert state(T.read_seats(spark, target)) == {("z", DAY): 9} and max(table.versions()) == 3
    broken = docs.withColumn("landed_at", F.raise_error(F.lit("broken")).cast("timestamp"))
    with pytest.raises(Exception, match="broken"):
        X.ingest_batch(broken, 2, target, history, staging)
    failed = T.read_history(spark, history).filter(F.col("status") == fv.RUN_FAILED).collect()
    assert [r.batch_id for r in failed] == ["2"] and "broken" in failed[0].note
