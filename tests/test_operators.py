import datetime as dt
import itertools
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from berthline import dims
from berthline.operators import entities as E
from berthline.operators.containment import _keys, contained
from berthline.operators import listing as L
from berthline.operators import metrics as M
from berthline.operators import rollups as C
from berthline.operators.dedup import (
    dedup_audit,
    dedup_first,
    dedup_last,
    drop_seen,
    merge_sources,
)

DAY = dt.date(2026, 4, 1)


# --- dedup ------------------------------------------------------------------------


def _rows(spark, rows, schema="ord int, k string, v int"):
    return spark.createDataFrame(rows, schema)


def test_last_and_first_do_not_depend_on_row_order(spark):
    rows = [(i, random.Random(i).choice(["a", "b", None]), i * 10) for i in range(60)]
    want_last = {k: max(o for o, x, _ in rows if x == k) for k in ("a", "b", None)}
    want_first = {k: min(o for o, x, _ in rows if x == k) for k in ("a", "b", None)}
    for seed in range(2):
        shuffled = random.Random(seed).sample(rows, len(rows))
        df = _rows(spark, shuffled).repartition(seed + 2)
        last, first = dedup_last(df, ["k"], "ord"), dedup_first(df, ["k"], "ord")
        assert {r.k: r.ord for r in last.collect()} == want_last
        assert {r.k: r.ord for r in first.collect()} == want_first
        assert sorted(dedup_last(last, ["k"], "ord").collect()) == sorted(last.collect())


def test_dedup_cuts_keys_before_the_shuffle(spark):
    plan = plan_of(dedup_last(_rows(spark, [(1, "a", 1)]).repartition(3), ["k"], "ord"))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_sources_merge_and_audit(spark):
    a = _rows(spark, [(5, "x", 1), (6, None, 1)])
    b = _rows(spark, [(1, "x", 2), (2, "y", 2), (3, "y", 3), (4, None, 2)]).withColumn("w", F.lit(1))
    merged = merge_sources([(0, a), (1, b)], ["k"])
    assert {(r.k, r.v, r.w) for r in merged.collect()} == {("x", 1, None), (None, 1, None), ("y", 2, 1)}
    assert {r.ord for r in drop_seen(b, a, ["k"]).collect()} == {2, 3}
    assert tuple(dedup_audit(b, ["k"]).first()) == (4, 3, 1)
    assert tuple(dedup_audit(b.limit(0), ["k"]).first()) == (0, 0, 0)


# --- entities ---------------------------------------------------------------------


def _brute(name, area, table, strict):
    names = [n for _, n, _, _ in table]

    def inside(a, b):
        return (not strict or (a and b)) and (a in b or b in a)

    stages = [
        lambda n, a: (n, a) == (name, area),
        lambda n, a: n == name and inside(a, area),
        lambda n, a: n == name and names.count(n) == 1,
        lambda n, a: inside(n, name) and names.count(n) == 1,
    ]
    for number, hit in enumerate(stages, 1):
        for _, n, a, boat in table:
            if hit(n, a):
                return boat, number
    return None, None


@pytest.mark.parametrize("strict", [True, False])
def test_resolution_equals_brute_force(spark, strict):
    names = ["ab", "abc", "b", "xyz", "", "zab", "q"]
    areas = ["n1", "n12", "2", "", "k"]
    table = [
        (0, "ab", "n12", 10),
        (1, "ab", "n1", 11),
        (2, "b", "k", 12),
        (3, "xyz", "n", 13),
        (4, "yz", "k", 14),
        (5, "zabq", "k", 15),
    ]
    entities = spark.createDataFrame(table, dims.ENTITY_SCHEMA)
    pairs = list(itertools.product(names, areas))
    df = spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], "ship_name string, area_sub string, i int")
    got = {
        (r.ship_name, r.area_sub): (r.boat_id, r.match_stage)
        for r in E.resolve_entities(df, entities, strict).collect()
    }
    assert got == {p: _brute(*p, table, strict) for p in pairs}


def test_known_boats(spark):
    rows = [
        ("만선호", "태안", 64),
        ("에이스호", "제주시", 1991),  # area contained
        ("뉴고니호", "부산", 2090),  # listed once
        ("뉴고니호 2", "부산", 2090),  # name contained
        ("에이스호", "부산", None),  # listed five times
        ("nobody", "태안", None),
    ]
    df = spark.createDataFrame(rows, "ship_name string, area_sub string, want bigint")
    found = E.resolve_entities(df, dims.entity_map(spark), coords=dims.boat_coords(spark))
    located = E.choose_coordinates(found, None).collect()
    assert all(r.boat_id == r.want for r in located)
    assert {r.lat for r in located if r.boat_id == 64} == {36.7456}
    assert {r.lat for r in located if r.boat_id is None} == {None}


def test_resolution_compares_no_pairs(spark):
    df = spark.createDataFrame([("a", "b")], "ship_name string, area_sub string")
    plan = plan_of(E.resolve_entities(df, dims.entity_map(spark)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_resolution_reads_the_listing_twice(spark, tmp_path, monkeypatch):
    """Once for its distinct pairs, once for the rows that get the result; the counts of a date once."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    listing = spark.range(40).selectExpr("concat('s', id % 7) as ship_name", "concat('a', id % 3) as area_sub", "date '2026-04-01' as fishing_date")
    listing.write.parquet(str(tmp_path / "listing"))
    df, known, plans = spark.read.parquet(str(tmp_path / "listing")), spark.createDataFrame([(0, "s1", "a1", 5), (1, "s", "", 6)], dims.ENTITY_SCHEMA), []
    store = E.stored
    monkeypatch.setattr(E, "stored", lambda frame, path: plans.append(frame) or store(frame, path))

    def scans(last):
        return [plan_of(frame).split("Initial Plan")[-1].count("/listing]") for frame in [*plans, last]]

    assert sum(scans(E.resolve_entities(df, known, scratch=str(tmp_path / "x")))) == 2
    plans.clear()
    assert sum(scans(E.matched_per_date(df, known, scratch=str(tmp_path / "y")))) == 1


def test_pieces_and_matches_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Their number is not what the size of the compressed files that they come from tells Spark."""
    spark.range(400).selectExpr("'k' as by", "concat('boat ', id) as whole", "id as whole_hit").write.parquet(str(tmp_path / "wholes"))
    wholes = spark.read.parquet(str(tmp_path / "wholes"))
    parts = spark.createDataFrame([("k", "boat 39", 1)], "by string, part string, part_hit long")
    found = contained(parts, wholes, ["by"])
    assert "Broadcast" not in plan_of(found) and found.count() == 11
    listing = wholes.selectExpr("whole as ship_name", "'x' as area_sub")
    known = listing.selectExpr("cast(0 as int) as ord", "ship_name as name", "area_sub as area", "cast(7 as int) as boat_id")
    assert "Broadcast" in plan_of(E.resolve_entities(listing, known, scratch=str(tmp_path / "few")))
    monkeypatch.setattr("berthline.session.BROADCAST_FILE_BYTES", 0)
    many = E.resolve_entities(listing, known, scratch=str(tmp_path / "many"))
    assert "Broadcast" not in plan_of(many) and many.filter("boat_id = 7").count() == 400


@pytest.mark.parametrize(("q", "empty"), [(3, False), (2, True), (1, False)])
def test_containment_equals_brute_force(spark, q, empty):
    texts = ["", "a", "ab", "abc", "bca", "abcabc", "xabcx", "\U0001f41f\U0001f41fab", "\U0001f41f", "zz", "zzz", "z z", None, "x" * 300, "x" * 299]
    rows = [(by, text, hit) for hit, (by, text) in enumerate(itertools.product(["k", "l", None], texts))]
    parts = spark.createDataFrame(rows + [("k", "ab", 0)], "by string, part string, part_hit int")
    wholes = spark.createDataFrame([r for r in rows if r[1] != "zz" or r[0] == "k"], "by string, whole string, whole_hit int")
    found = contained(parts, wholes, ["by"], q, empty)
    want = {
        (by, part, whole) for by, part, whole in itertools.product(["k", "l"], texts, texts)
        if part is not None and whole is not None and part in whole and (part or empty) and (whole != "zz" or by == "k")
    }
    got = [(r.by, r.part, r.whole) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)
    assert found.filter("by = 'k' and part = 'ab'").first().part_hit == 0
    # a text has at most q keys a letter, a part one key
    assert wholes.select(F.max(F.size(_keys(F.col("whole"), q, empty)) - q * F.length("whole"))).first()[0] <= 1


def test_coordinates_come_as_a_pair(spark):
    rows = [(64, 1.0, None), (None, 1.0, 2.0), (9, None, 2.0)]
    df = spark.createDataFrame(rows, "boat_id bigint, feed_lat double, feed_lng double")
    got = {r.boat_id: (r.lat, r.lng) for r in E.apply_coordinates(df, dims.boat_coords(spark)).collect()}
    assert got == {64: (36.7456, 126.2979), None: (1.0, 2.0), 9: (None, 2.0)}


def test_areas_by_expression_and_by_table(spark):
    texts = ["태안군", "인천 중구", "서귀포", "nowhere", "", "고성 강릉"]
    df = spark.createDataFrame([(t, None) for t in texts], "area_sub string, area_main string")
    by_case = {r.area_sub: r.area_main for r in E.lookup_area(df).collect()}
    by_join = {r.area_sub: r.area_main for r in E.lookup_area(df, dims.area_map(spark)).collect()}
    assert by_case == by_join
    assert [by_case[t] for t in texts] == ["충남", "인천", "제주", "기타", "기타", "경남"]
    own = E.lookup_area(df.withColumn("area_main", F.lit("own"))).first()
    assert own.area_main == "own"


# --- listing ----------------------------------------------------------------------


@pytest.fixture
def seats(spark):
    rows = [
        (1, "Red", "충남", "태안", DAY, "광어, 우럭", 50, 0, 30, "ING"),
        (2, "red 2", "충남", "보령", DAY, "넙치", 50, 0, 0, "FULL"),
        (3, "Blue", "강원", "강릉", None, "쭈꾸미", 0, 0, 5, "ING"),
        (4, "Gull", "강원", "강릉", dt.date(2026, 4, 3), "", 50, 0, None, "END"),
    ]
    return spark.createDataFrame(
        rows,
        "ord int, ship_name string, area_name string, port_name string, fishing_date date, fish_types string, "
        "total_seats int, reserved_seats int, remain_seats int, status_code string",
    )


def _ords(df):
    return sorted(r.ord for r in df.collect())


def test_filters(seats):
    def hits(**kw):
        return _ords(L.apply_filters(seats, L.Filters(**kw)))

    assert hits() == [1, 2, 3, 4]
    assert hits(name="RED") == [1, 2]
    assert hits(species="광어") == [1, 2]
    assert hits(date=DAY) == [1, 2]
    assert hits(status="END") == [2, 4] and hits(status="FULL") == [2, 4]
    assert hits(seats_only=True) == [1, 3]
    assert hits(query="주꾸미 강릉") == [3]
    assert hits(query="넙치 충남", seats_only=True) == [1]
    assert tuple(L.filter_counts(seats, L.Filters(query="강릉")).first()) == (2, 4)


def test_fuzzy_search(seats):
    assert _ords(L.fuzzy_search(seats, "blux")) == [3]
    assert _ords(L.fuzzy_search(seats, "bxux")) == []
    assert _ords(L.fuzzy_search(seats, "gul")) == [4]


def test_cards_and_facets(seats):
    cards = L.summary_cards(seats).first()
    assert (cards.ships, cards.avail, cards.full, cards.seats) == (4, 2, 2, 35)
    assert (cards.with_seats, cards.dates) == (2, 3)
    assert L.summary_cards(seats.limit(0)).first().ships == 0
    assert [r.species for r in L.facet_species(seats).collect()] == ["광어", "넙치", "우럭", "쭈꾸미"]
    assert [r.fishing_date.day for r in L.facet_dates(seats).collect()] == [1, 3]


def test_pages(seats):
    def page(n, **kw):
        return [r.ord for r in L.sort_page(seats, page=n, size=3, ties=["ord"], **kw).collect()]

    assert page(1) == [3, 1, 2] and page(2) == [4] and page(3) == [] and page(0) == []
    assert page(1, col="ship_name", asc=False) == [2, 1, 4]
    assert "TakeOrderedAndProject" in plan_of(L.sort_page(seats, ties=["ord"]))
    after = {"fishing_date": DAY, "ord": 1}
    assert [r.ord for r in L.page_after(seats, after, ties=["ord"]).collect()] == [2, 4]
    assert L.page_count(seats, 3).first().pages == 2
    with pytest.raises(ValueError):
        L.sort_page(seats, "status_code")


def test_group_headers(seats):
    order = L.sort_keys(seats, "fishing_date", True, ["ord"])
    marked = L.mark_group_headers(seats, order)
    assert {r.ord: r.group_header for r in marked.collect()} == {3: False, 1: True, 2: False, 4: True}


# --- rollups, metrics ---------------------------------------------------------------


def test_calendar_operators(spark, seats):
    spine = C.days_ahead(spark, DAY, 3)
    assert [r.date.day for r in spine.collect()] == [1, 2, 3]
    assert _ords(C.in_window(seats, spine)) == [1, 2, 4]
    assert [r.date.day for r in C.coverage_gaps(seats, spine).collect()] == [2]
    long = C.date_spine(spark, dt.date(2025, 12, 30), dt.date(2026, 1, 2))
    assert [tuple(r) for r in C.spine_months(long).collect()] == [(2025, 12), (2026, 1)]
    assert [tuple(r) for r in C.chunk_running(seats, DAY, 2).orderBy("chunk").collect()] == [
        (0, 2, 2),
        (1, 1, 3),
    ]


def test_shares(seats):
    shares = C.share_top_k(C.species_counts(seats), 2, "rest").collect()
    assert {(r.name, r.rows, r.pct) for r in shares} == {
        ("광어", 1, 25.0),
        ("넙치", 1, 25.0),
        ("rest", 2, 50.0),
    }
    assert C.share_top_k(C.species_counts(seats.limit(0)), 2).count() == 0


def _daily(spark, rows):
    schema = (
        "date date, gmv decimal(18,2), bookings bigint, sessions bigint, cvr double, ships bigint, members bigint, "
        "ad_spend_meta decimal(18,2), ad_spend_google decimal(18,2)"
    )
    return spark.createDataFrame(rows, schema)


def _ads(spark, rows):
    schema = (
        "report_date date, impressions bigint, clicks bigint, conversions bigint, ad_spend decimal(18,2), "
        "revenue decimal(18,2), roas double"
    )
    return spark.createDataFrame(rows, schema)


def test_week_over_week_needs_the_exact_day(spark):
    from decimal import Decimal as D

    rows = [
        (dt.date(2026, 4, 1), D(100), 10, 0, None, 1, 1, None, None),
        (dt.date(2026, 4, 8), D(150), 0, 5, None, 2, 2, D(5), None),
        (dt.date(2026, 4, 9), D(150), 9, 5, 3.0, 2, 2, None, None),
    ]
    daily = _daily(spark, rows)
    days = M.mastered(daily, _ads(spark, [(dt.date(2026, 4, 8), 1, 1, 1, D(7), D(0), 0.0)]))
    found = M.kpi_latest(days, dt.date(2026, 4, 8)).first()
    assert (found.gmv_wow_pct, found.bookings_wow_pct, float(found.total_ad_spend)) == (50.0, -100.0, 12.0)
    later = M.kpi_latest(days, dt.date(2026, 4, 30)).first()
    assert later.report_date.day == 9 and later.gmv_wow_pct is None
    assert M.kpi_latest(days, dt.date(2026, 3, 1)).count() == 0
    by_day = {r.date.day: r for r in days.collect()}
    assert by_day[1].cvr_pct is None and by_day[8].cvr_pct == 0.0 and by_day[9].cvr_pct == 3.0
    assert by_day[1].naver_booking_share_pct is None and by_day[8].naver_booking_share_pct is None
    assert M.kpi_fallback(daily).first().report_date == "2026-04-09"
    assert M.kpi_fallback(daily.limit(0)).count() == 0


def test_months_kept(spark):
    months = spark.createDataFrame([(f"2026-{m:02d}",) for m in range(1, 8)], "year_month string")
    assert {r.year_month for r in M.keep_months(months, 2).collect()} == {"2026-06", "2026-07"}
    assert {r.year_month for r in M.keep_months(months, 2, "oldest").collect()} == {"2026-01", "2026-02"}
    with pytest.raises(ValueError):
        M.keep_months(months, 2, "best")
