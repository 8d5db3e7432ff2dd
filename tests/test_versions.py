import datetime as dt

import pytest
from pyspark.sql import functions as F

from berthline import session
from berthline.operators import interleave
from berthline.operators import listing as L
from berthline.schemas import NATURAL_KEY
from berthline.sinks import counts as C
from berthline.sinks import tables as T
from berthline.sinks.versions import PublishConflict, VersionedTable
from test_outputs import DAY, seat, state

NEXT = dt.date(2026, 4, 2)


def files(spark, path):
    return sorted(f.rsplit("/", 1)[1] for f in T.read_seats(spark, path).inputFiles())


def test_a_run_that_stops_between_partitions_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "seats")
    T.upsert(path, seat(spark, (1, "a", DAY, 0, 1), (2, "b", NEXT, 0, 2)))
    old = state(T.read_seats(spark, path))
    table = T.seats(spark, path)
    # one date of the batch is on disk, the other is not, and nothing is published
    table.write(T.read_seats(spark, path).filter(F.col("fishing_date") == DAY).withColumn("remain_seats", F.lit(99).cast("bigint")), "half")
    assert state(T.read_seats(spark, path)) == old
    # both dates are written, the pointer fails
    monkeypatch.setattr("berthline.sinks.versions.write_new", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        T.upsert(path, seat(spark, (1, "a", DAY, 1, 5), (2, "b", NEXT, 1, 6)), name="n")
    monkeypatch.undo()
    assert state(T.read_seats(spark, path)) == old and table.versions() == [1] and not table.published("n")
    # the same batch again is published from what was written
    assert T.upsert(path, seat(spark, (1, "x", DAY, 1, 5)), name="n") == 2 and table.published("n")
    assert state(T.read_seats(spark, path)) == {("a", DAY): 5, ("b", NEXT): 6}


def test_readers_keep_their_version_and_roll_back(spark, tmp_path):
    path = str(tmp_path / "seats")
    T.upsert(path, seat(spark, (1, "a", DAY, 0, 1), (2, "b", None, 0, 2)))
    before, first = T.read_seats(spark, path), files(spark, path)
    T.upsert(path, seat(spark, (1, "a", DAY, 1, 5), (3, "c", NEXT, 0, 3)))
    assert state(before) == state(T.read_seats(spark, path, 1)) == {("a", DAY): 1, ("b", None): 2}
    assert state(T.read_seats(spark, path)) == {("a", DAY): 5, ("b", None): 2, ("c", NEXT): 3}
    table = T.seats(spark, path)
    assert table.moved(1) == [f"fishing_date={DAY}", f"fishing_date={NEXT}"]
    assert table.rollback(1) == 3 and state(T.read_seats(spark, path)) == {("a", DAY): 1, ("b", None): 2}
    assert files(spark, path) == first and table.pointer().notes == {"rolled_back_to": 1}
    assert table.rollback(0) == 4 and T.read_seats(spark, path).count() == 0


def test_two_writers_from_one_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), spark.range(1).schema)
    one, two = table.write(spark.range(1)), table.write(spark.range(2))
    assert table.publish(one, 0) == 1
    with pytest.raises(PublishConflict):
        table.publish(two, 0)
    assert table.read().count() == 1 and not [n for n in session.list_names(spark, str(tmp_path / "t/versions")) if n.endswith(".tmp")]


def test_a_full_refresh_that_fails_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    T.full_refresh(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        T.full_refresh(T.read_refreshed(spark, path).withColumn("id", F.raise_error(F.lit("broken")).cast("bigint")), path)
    assert T.read_refreshed(spark, path).count() == 3 and T.read_refreshed(spark, path, 1).count() == 3
    with pytest.raises(ValueError, match="no table"):
        T.read_refreshed(spark, str(tmp_path / "none"))


def test_expired_versions_go_and_shared_folders_stay(spark, tmp_path):
    path = str(tmp_path / "seats")
    T.upsert(path, seat(spark, (1, "a", DAY, 0, 1), (2, "b", NEXT, 0, 2)))
    for hour in (1, 2):
        T.upsert(path, seat(spark, (1, "a", DAY, hour, hour)))
    table = T.seats(spark, path)
    unpublished = table.write(T.read_seats(spark, path), "in-flight")
    assert table.expire(2) == 1 and table.versions() == [2, 3]
    assert state(T.read_seats(spark, path)) == {("a", DAY): 2, ("b", NEXT): 2} and state(T.read_seats(spark, path, 2)) == {("a", DAY): 1, ("b", NEXT): 2}
    assert table.is_written(unpublished)


def test_change_rows_read_moved_dates_only(spark, tmp_path):
    path = str(tmp_path / "seats")
    T.upsert(path, seat(spark, (1, "a", DAY, 0, 1), (2, "b", NEXT, 0, 2), (3, "c", None, 0, 3), (4, "same", None, 0, 4)))
    T.upsert(path, seat(spark, (1, "a", DAY, 1, 5), (2, "new", None, 0, 6), (3, "c", None, -1, 7)))
    table = T.seats(spark, path)

    def told(since, until):
        rows = table.changes(NATURAL_KEY, since, until)
        return {(r.old and (r.old.ship_name, r.old.remain_seats), r.new and (r.new.ship_name, r.new.remain_seats)) for r in rows.collect()}

    assert told(1, 2) == {(("a", 1), ("a", 5)), (None, ("new", 6))}
    assert told(2, 1) == {(("a", 5), ("a", 1)), (("new", 6), None)}
    assert len(told(0, 1)) == 4 and told(2, 2) == set()
    assert not any(f"fishing_date={NEXT}" in f for f in table.changes(NATURAL_KEY, 1, 2).inputFiles())


def test_counts_follow_batches_late_rows_and_rollbacks(spark, tmp_path):
    path, counts = str(tmp_path / "seats"), str(tmp_path / "counts")

    def check():
        C.refresh_counts(spark, path, counts)
        now, kept = T.read_seats(spark, path), C.counts_table(spark, counts).read()
        assert C.kept_cards(kept).select(*L.summary_cards(now).columns).first() == L.summary_cards(now).first()
        species = L.facet_species(now)
        assert {r["value"] for r in C.kept_facet(kept, "species").collect()} == {r.species for r in species.collect()}
        assert [r.fishing_date for r in C.kept_dates(kept).orderBy("fishing_date").collect()] == [r.fishing_date for r in L.facet_dates(now).collect()]
        assert kept.filter("n <= 0").isEmpty()

    def typed(*rows, fish="x, y"):
        return seat(spark, *rows).withColumn("fish_types", F.lit(fish))

    T.upsert(path, typed((1, "a", DAY, 0, 1), (2, "b", NEXT, 0, 2), (3, "c", None, 0, 0)))
    check()
    T.upsert(path, typed((1, "a", DAY, 1, 5), (2, "a", DAY, -1, 7), (3, "d", DAY, 0, None), fish="y,z ,z"))
    T.upsert(path, typed((1, "c", None, 1, 4), fish=None))
    check()
    version = C.counts_table(spark, counts).pointer().version
    assert C.refresh_counts(spark, path, counts) == version
    T.seats(spark, path).rollback(1)
    check()
    T.seats(spark, path).rollback(0)
    check()
    assert C.counts_table(spark, counts).read().count() == 0


def test_interleaved_order_lets_any_filter_skip_row_groups(spark, tmp_path):
    rows = [(i, f"s{i}", DAY, 0, (i * 7919) % 100) for i in range(4000)]
    batch = seat(spark, *rows).withColumns({"area_name": F.concat(F.lit("a"), (F.col("ord") * 31 % 16).cast("string")), "port_name": F.when(F.col("ord") % 9 > 0, F.col("ord").cast("string"))}).coalesce(1)
    small = {"parquet.block.size": 1024, "parquet.page.row.count.limit": 100, "parquet.block.row.count.limit": 100}

    def read(path, where):
        """Rows that the filter keeps, and rows that the scan read for it."""
        df = T.read_seats(spark, path).filter(where)
        kept = sorted(r.ship_name for r in df.collect())
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        return kept, scan.metrics().apply("numOutputRows").value()

    plain, laid = str(tmp_path / "plain"), str(tmp_path / "laid")
    T.upsert(plain, batch, **small)
    T.upsert(laid, batch, cluster_by=["area_name", "remain_seats"], **small)
    for where in ("area_name = 'a7'", "remain_seats between 40 and 44", "area_name = 'a3' and remain_seats < 5"):
        want, all_rows = read(plain, where)
        got, few = read(laid, where)
        assert got == want and len(got) >= 10 and few < all_rows / 2, (where, few, all_rows)


def test_place_is_the_interleaved_bits(spark):
    df = spark.createDataFrame([(x, chr(97 + y)) for x in range(4) for y in range(4)] + [(None, None)], "x int, y string")
    assert interleave.boundaries(df, "x", 2) == [1, 2, 3] and interleave.boundaries(df.filter("x = 9"), "y") == []
    placed = {(r.x, r.y): r.p for r in df.withColumn("p", interleave.interleaved(df, ["x", "y"], 2)).collect()}
    want = {(x, chr(97 + y)): (x & 1) | (y & 1) << 1 | (x >> 1) << 2 | (y >> 1) << 3 for x in range(4) for y in range(4)}
    assert placed == want | {(None, None): 0}
