"""Schemas of the tables that the engine reads and writes."""

from pyspark.sql import types as T

_S, _L, _D, _DATE = T.StringType(), T.LongType(), T.DoubleType(), T.DateType()
MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


NATURAL_KEY = ["ship_name", "fishing_date", "depart_time", "schedule_no"]
SHIP_KEY = ["ship_name", "sdate", "stime", "schedule_no"]

# 16-column availability snapshot.
SEAT_ROW = _struct(
    ("collected_at", T.TimestampNTZType()),
    ("ship_name", _S),
    ("area_name", _S),
    ("port_name", _S),
    ("fishing_date", _DATE),
    ("depart_time", _S),
    ("return_time", _S),
    ("fish_types", _S),
    ("fishing_methods", _S),
    ("price", _S),
    ("total_seats", _L),
    ("reserved_seats", _L),
    ("remain_seats", _L),
    ("status_code", _S),
    ("status_name", _S),
    ("schedule_no", _S),
)
SEAT_COLUMNS = SEAT_ROW.fieldNames()

# Text widths of a table for export.
SEAT_WIDTHS = {
    "ship_name": 100,
    "area_name": 50,
    "port_name": 100,
    "price": 50,
    "status_code": 20,
    "status_name": 50,
    "schedule_no": 50,
}

# Unified row of both marketplaces (superset of their fields).
SHIP_ROW = _struct(
    ("ship_no", _L),
    ("feed_ship_no", _L),
    ("directory_id", _S),
    ("ship_name", _S),
    ("area_main", _S),
    ("area_sub", _S),
    ("lat", _D),
    ("lng", _D),
    ("sdate", _S),
    ("stime", _S),
    ("etime", _S),
    ("fish_type", _S),
    ("method", _S),
    ("remain", _L),
    ("status", _S),
    ("status_name", _S),
    ("price", _L),
    ("schedule_no", _S),
    ("source", _S),
)

# 20-column dashboard payload row, in position order.
PAYLOAD_COLUMNS = SEAT_COLUMNS + ["boat_id", "source", "lat", "lng"]
PAYLOAD_TYPES = {f.name: f.dataType for f in SEAT_ROW} | {
    "collected_at": _S,
    "fishing_date": _S,
    "boat_id": _L,
    "source": _S,
    "lat": _D,
    "lng": _D,
}

DAILY_METRICS = _struct(
    ("date", _DATE),
    ("gmv", MONEY),
    ("bookings", _L),
    ("sessions", _L),
    ("cvr", _D),
    ("ships", _L),
    ("members", _L),
    ("ad_spend_meta", MONEY),
    ("ad_spend_google", MONEY),
    ("ad_roas", _D),
    ("ad_cpa", _D),
)

AD_DAILY = _struct(
    ("report_date", _DATE),
    ("impressions", _L),
    ("clicks", _L),
    ("conversions", _L),
    ("ad_spend", MONEY),
    ("revenue", MONEY),
    ("roas", _D),
    ("ctr", _D),
    ("cvr_ad", _D),
)

RUN_HISTORY = _struct(
    ("collected_at", T.TimestampNTZType()),
    ("batch_id", _S),
    ("row_count", _L),
    ("status", _S),
    ("note", _S),
)

# A feed page as landed by one run; the newest run's page of a date and number counts.
LANDED_PAGE = _struct(
    ("run_ts", T.TimestampNTZType()),
    ("request_date", _DATE),
    ("page", T.IntegerType()),
    ("value", _S),
)
