import datetime as dt
import json

from conftest import plan_of
from pyspark.sql import functions as F

from berthline.sources.calendar_html import page_cells
from berthline.sources.html_pages import directory_ids, extract_calendar, extract_directory
from berthline.sources.landed import (
    assemble_pages,
    broken_docs,
    explode_landed,
    load_dates,
    manifest_dates,
    normalize_aliases,
    parse_pages,
    read_landed,
    read_payload,
)
from berthline.sources.listing import (
    calendar_ships,
    fitted,
    parse_listing_v1,
    parse_listing_v2,
    split_rejects,
)
from berthline.sources.tables import read_ad_sheet, read_ad_sheet_csv
from berthline.workloads.fixtures import Tables



def run_ts():
    return F.lit(dt.datetime(2026, 4, 1, 1, 0)).cast("timestamp_ntz")


def _docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "n int, value string")


def test_document_shapes(spark):
    docs = _docs(
        spark,
        '[{"name":"a"},3,"x",{"name":"b"}]',
        '{"data":[],"records":[{"name":"c"}],"ships":[{"name":"no"}]}',
        '{"zz":[1],"b":[{"name":"d"}],"a":[{"name":"no"}]}',
        '{"data":{"name":"no"},"ships":[{"name":"no"}]}',
        "{}",
        "17",
        "not json",
    )
    rows = explode_landed(docs).select("n", "pos", F.variant_get("rec", "$.name", "string"))
    assert sorted(tuple(r) for r in rows.collect()) == [
        (0, 0, "a"),
        (0, 3, "b"),
        (1, 0, "c"),
        (2, 0, "d"),
    ]
    assert [r.n for r in broken_docs(docs).collect()] == [6]


def test_alias_order_and_json_null(recs):
    df = recs(
        '{"name":null,"ship_name":"b","available":"7","remain_seats":null,"price":"call","schedule_no":5}',
        '{"name":"","ship_name":"no","remain_embarkation_num":"7.5","available":3,"fish_type":[{"name":"x"},"y"]}',
        '{"area_main":"m","area_sub":"s","method":"lure","remain":4.9,"status":"ING"}',
    )
    rows = normalize_aliases(df, run_ts()).orderBy("n").collect()
    a, b, c = rows
    assert (a.ship_name, a.remain_seats, a.price, a.schedule_no) == ("b", 7, "call", "5")
    assert (b.ship_name, b.remain_seats, b.fish_types, b.price) == ("", 0, "x,y", "0")
    assert (c.area_name, c.port_name, c.fishing_methods, c.remain_seats) == ("m", "s", "lure", 4)
    assert c.status_code == "ING" and c.fishing_date == ""


def test_listing_v1_values_and_rejects(recs):
    good = {
        "name": "n" * 101,
        "area_name": "a",
        "fish_type": [{"name": "x"}, {"name": "y"}],
        "price": 12000,
        "sdate": "bad",
        "stime": None,
        "embarkation_num": None,
        "remain_embarkation_num": 4,
        "ship_schedule_no": 77,
    }
    texts = [
        json.dumps(good),
        "{}",
        '{"name":null}',
        '{"name":"a","fish_type":[{"x":1}]}',
        '{"name":"a","price":"12"}',
        '{"name":"a","fish_type":null}',
        '{"name":"a","fish_type":"x"}',
        '{"name":7}',
        '{"name":"a","price":{}}',
    ]
    ok, bad = split_rejects(parse_listing_v1(recs(*texts), run_ts()))
    first, empty = ok.orderBy("n").collect()
    assert len(first.ship_name) == 101 and first.fish_types == "x, y"
    assert first.price == "12,000원" and first.fishing_date is None and first.depart_time == ""
    assert (first.total_seats, first.remain_seats, first.schedule_no) == (0, 4, "77")
    assert empty.ship_name == "" and empty.price == "전화문의"
    reasons = {r.n: r.reject_reason for r in bad.collect()}
    assert reasons == {
        2: "name is null",
        3: "fish_type without name",
        4: "price is text",
        5: "fish_type is null",
        6: "fish_type is no list",
        7: "name is no text",
        8: "price is no number",
    }
    assert len(fitted(ok).orderBy("n").first().ship_name) == 100
    _, missing = split_rejects(ok, ["fishing_date"])
    assert missing.count() == 2


def test_listing_v2_defaults(recs):
    texts = [
        '{"ship":{"no":5,"name":" a\\u3000","area_sub":" s ","area_main":""},"price":"12000","schedule_status_code":null}',
        '{"sdate":null,"price":"x","remain_embarkation_num":3,"stime":"05:30:00"}',
        '{"sdate":"2026-05-01","price":"","ship":null}',
    ]
    df = recs(*texts).withColumn("request_date", F.lit(dt.date(2026, 4, 1)))
    a, b, c = parse_listing_v2(df).orderBy("n").collect()
    assert (a.feed_ship_no, a.ship_name, a.area_sub, a.area_main) == (5, "a", "s", None)
    assert (a.sdate, a.status, a.price, a.remain) == ("2026-04-01", "ING", 12000, 0)
    assert (b.sdate, b.price, b.remain, b.stime, b.ship_name) == (None, None, 3, "05:30", "")
    assert (c.sdate, c.price) == ("2026-05-01", None)


def test_page_rules(spark):
    def page(n, total=0):
        return json.dumps({"total": total, "list": [{"i": i} for i in range(n)]})

    sizes = {1: 30, 2: 30, 3: 0, 4: 30}
    rows = [(dt.date(2026, 4, 1), p, page(n, 61)) for p, n in sizes.items()]
    rows += [(dt.date(2026, 4, 2), 1, page(12)), (dt.date(2026, 4, 2), 2, page(9))]
    rows += [(dt.date(2026, 4, 2), 3, page(12)), (dt.date(2026, 4, 3), 1, "oops")]
    pages = parse_pages(spark.createDataFrame(rows, "request_date date, page int, value string"))

    def kept(rule):
        out = assemble_pages(pages, rule).groupBy("request_date", "page").count().collect()
        return {(r.request_date.day, r.page): r["count"] for r in out}

    assert kept("empty") == {(1, 1): 30, (1, 2): 30, (2, 1): 12, (2, 2): 9, (2, 3): 12}
    assert kept("short") == {(1, 1): 30, (1, 2): 30, (2, 1): 12, (2, 2): 9}
    assert kept("total") == {(1, 1): 30, (1, 2): 30}


def test_calendar_cells():
    html = (
        "<table><td><span class='day'> 1 </span><span class=num>3</span></td>"
        '<td class="x"><div><span class="a day">2<b>0</b></span></div><span class="num">&#49;</span>'
        '<ul class="schedule2"><li>a &amp; b<br>c</li><script>var t="</td>";</script></ul>'
        "<a onclick=\"go('date=20260405')\">x</a></td>"
        "<td><span class='day'>3</span></td>"
        "<td><span class='day'>4</span><td><span class='num'>9</span></td></td>"
    )
    assert page_cells(html) == [
        ("1", "3", "", ""),
        ("20", "1", "a & b c", "go('date=20260405')"),
        ("4", "9", "", ""),
    ]


def test_calendar_rows(spark):
    html = (
        "<td><span class='day'>1</span><span class='num'>3</span></td>"
        "<td><span class='day'>x</span><span class='num'>3</span></td>"
        "<td><span class='day'>2</span><span class='num'>closed</span>"
        "<a onclick='date=20260503'>go</a><ul class='schedule2'>" + "f" * 120 + "</ul></td>"
    )
    pages = spark.createDataFrame(
        [("7", 2026, 4, html)], "directory_id string, year int, month int, html string"
    )
    seats = extract_calendar(pages)
    got = {r.pos: (r.sdate, r.remain, len(r.fish_str), r.status) for r in seats.collect()}
    assert got == {0: ("2026-04-01", 3, 0, "ING"), 2: ("2026-05-03", 0, 120, "FULL")}
    boats = spark.createDataFrame(
        [("7", "1", "boat", "태안")],
        "directory_id string, store_id string, ship_name string, area_sub string",
    )
    ships = calendar_ships(seats, boats, dt.date(2026, 4, 2)).collect()
    assert [(s.schedule_no, s.status_name, s.price) for s in ships] == [
        ("tf_7_2026-05-03", "예약마감", None)
    ]


def test_directory(spark):
    links = "".join(f"<a href='list.php?a=1&uid={i % 70}'>x</a>\n" for i in range(200))
    ids = directory_ids(spark.createDataFrame([(1, links)], "page_id int, html string"))
    assert [r.directory_id for r in ids.orderBy("pos").collect()] == [str(i) for i in range(70)]
    pages = [("5", "st_uid=9&pa_uid=5 <title>x | y</title>"), ("6", "nothing")]
    rows = extract_directory(spark.createDataFrame(pages, "directory_id string, html string"))
    assert [tuple(r) for r in rows.collect()] == [("5", "9", "x", "")]


def test_ad_sheet(spark, tmp_path):
    header = " 날짜,노출수,클릭수,광고비\n"
    lines = '2026/04/01,"1,234",5 clicks,12.5%\n20260402,1,1,1\n,1,1,1\n2026-04-03,abc,,\n'
    (tmp_path / "sheet.csv").write_text(header + lines, encoding="utf-8")
    rows = read_ad_sheet_csv(spark, str(tmp_path / "sheet.csv")).orderBy("report_date").collect()
    assert [r.report_date.day for r in rows] == [1, 3]
    assert (rows[0].impressions, rows[0].clicks, rows[0].ad_spend, rows[0].roas) == (1234, 5, 12.5, 0.0)
    assert (rows[1].impressions, rows[1].ad_spend) == (0, 0.0)
    raw = spark.read.option("header", True).csv(str(tmp_path / "sheet.csv"))
    assert read_ad_sheet(raw, compact_dates=True).count() == 3


def test_manifest_shapes(spark):
    def dates(text, mode):
        return [r.date for r in manifest_dates(_docs(spark, text), mode).collect()]

    assert dates('["2026-04-02","2026-04-01"]', "all") == ["2026-04-01", "2026-04-02"]
    assert dates('{"dates":[{"date":"2026-04-02","total":1}]}', "latest") == ["2026-04-02"]
    assert dates('{"dates":["2026-04-02"],"latest":"2026-04-09"}', "latest") == ["2026-04-09"]
    assert dates('{"n":1}', "latest") == []


def test_files(spark, tmp_path):
    for day, name in [("2026-04-01", "a"), ("2026-04-02", "b")]:
        (tmp_path / f"{day}.json").write_text(json.dumps([{"name": name}]), encoding="utf-8")
    name = F.variant_get("rec", "$.name", "string").alias("name")
    all_rows = read_landed(spark, str(tmp_path)).select("file_date", name).collect()
    assert {(str(r.file_date), r.name) for r in all_rows} == {("2026-04-01", "a"), ("2026-04-02", "b")}
    some = load_dates(spark, str(tmp_path), ["2026-04-02", "2026-04-09"]).select(name).collect()
    assert [r.name for r in some] == ["b"]
    payload = {"updated_at": "t", "rows": [["t", "s", "a", "p", "2026-04-01", "05:30"] + [None] * 10]}
    (tmp_path / "p.txt").write_text(json.dumps(payload), encoding="utf-8")
    row = read_payload(spark, str(tmp_path / "p.txt")).first()
    assert (row.ship_name, row.depart_time, row.boat_id, row.remain_seats) == ("s", "05:30", None, None)


def test_calendar_text_at_the_end_of_a_cut_page():
    assert page_cells("<td><span class='day'>3</span><span class='num'>5") == [("3", "5", "", "")]
    deep = "<td>" + "<b>" * 20_000 + "<span class='day'>1</span><span class='num'>2</span>" + "</i>" * 20_000
    assert page_cells(deep) == [("1", "2", "", "")]


def test_decimal_prices(recs):
    rows = parse_listing_v1(recs('{"price":12000.5}', '{"price":99999999999999999999}', '{"price":1.25e3}', '{"price":0.0}'), run_ts())
    assert [r.price for r in rows.orderBy("n").collect()] == ["12,000.5원", "99,999,999,999,999,999,999원", "1,250원", "전화문의"]


def test_large_tables_are_not_broadcast_to_the_orders(spark, tmp_path, monkeypatch):
    """Their compressed files are below Spark's threshold long before their hash tables fit the driver."""
    rows = {
        "region": "0 as r_regionkey, 'ASIA' as r_name",
        "nation": "0 as n_nationkey, 'NATION_0' as n_name, 0 as n_regionkey",
        "customer": "id as c_custkey, 'c' as c_name, 0 as c_nationkey, 1D as c_acctbal, 'X' as c_mktsegment",
        "part": "id as p_partkey, 'red gear' as p_name, 'B' as p_brand, 'T' as p_type, 1 as p_size, 1D as p_retailprice",
        "orders": "id as o_orderkey, id as o_custkey, 'O' as o_orderstatus, 5D as o_totalprice, timestamp_ntz '2000-05-22' as o_orderdate, '1' as o_orderpriority",
    }
    for name, columns in rows.items():
        spark.range(1 if name in ("region", "nation") else 4).selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    joins = lambda: [plan_of(Tables(spark, str(tmp_path)).seat_listing).count(f"{kind}Join [") for kind in ("BroadcastHash", "SortMerge")]
    assert joins() == [4, 0]
    monkeypatch.setattr("berthline.session.BROADCAST_FILE_BYTES", 0)
    assert joins() == [2, 2] and Tables(spark, str(tmp_path)).seat_listing.count() == 4
