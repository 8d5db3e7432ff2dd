import datetime as dt

from pyspark.sql import functions as F

from berthline import functions as X
from berthline.functions.text import expand_synonyms, join_names


def test_tolerant_numbers(one):
    texts = ["1,234", " 12abc", "abc", "", "-5.9", None]
    for text, want in zip(texts, [1234, 12, 0, 0, -5, 0]):
        assert one(X.tolerant_int("x"), x=text) == (want,)
    texts = ["1,234.5", "12.5%", ".5e1x", "abc", None]
    for text, want in zip(texts, [1234.5, 12.5, 5.0, 0.0, 0.0]):
        assert one(X.tolerant_float("x"), x=text) == (want,)


def test_strict_int(one):
    for text, want in [("12", 12), (" 12 ", 12), ("12.5", 7), ("x", 7), (None, 7)]:
        assert one(X.strict_int("x", 7), x=text) == (want,)
    assert one(X.strict_int(F.lit(12.9)), x="") == (12,)


def test_ratios_and_report_numbers(one):
    assert one(X.safe_ratio(F.lit(1), F.lit(0)), x="") == (None,)
    assert one(X.percent(F.lit(1), F.lit(8)), x="") == (12.5,)
    nan = F.lit(float("nan"))
    assert one(X.report_float(nan), X.report_float(F.lit(2.25)), x="") == (0.0, 2.3)
    assert one(X.report_int(F.lit(None).cast("int")), x="") == (0,)


def test_dates(one):
    day = dt.date(2026, 4, 1)
    for text, want in [("2026-04-01", day), ("2026-4-1", None), ("2026-13-01", None), ("", None)]:
        assert one(X.iso_date("x"), x=text) == (want,)
    for text, want in [("2026/04/01", day), ("2026-04-01", day), ("20260401", None), ("x", None)]:
        assert one(X.sheet_date("x"), x=text) == (want,)
    assert one(X.sheet_date("x", compact=True), x="20260401") == (day,)
    assert one(X.date_with_weekday("x"), x="2026-04-01") == ("2026-04-01 (수)",)
    assert one(X.date_with_weekday("x"), x="soon") == ("soon",)
    assert one(X.date_with_weekday("x"), x=None) == ("",)
    assert X.business_date(dt.datetime(2026, 1, 1, 16)) == dt.date(2026, 1, 2)
    late = F.lit(dt.datetime(2026, 1, 1, 16)).cast("timestamp")
    assert one(X.business_date_column(late), x="") == (dt.date(2026, 1, 2),)


def test_texts(one):
    assert one(X.clock("x"), X.truncate("x", 2), x="05:30:00") == ("05:30", "05")
    assert one(X.clock("x"), x=None) == ("",)
    assert one(X.strip("x"), x="　\t a b \n") == ("a b",)
    assert one(X.or_default("x", "d"), x="") == ("d",)
    assert one(X.price_label(F.lit(12000)), X.price_label(F.lit(0)), x="") == ("12,000원", "전화문의")
    assert one(X.price_label(F.lit(None).cast("bigint")), x="") == ("전화문의",)
    assert one(X.text_price(F.lit(12)), X.text_price(F.lit(0)), x="") == ("12", "")
    assert one(X.month_label("x"), x="2026-04") == ("04월",)
    assert one(X.month_label("x"), x="2026") == ("2026",)
    assert one(X.split_species("x"), x=" a, ,b ,,") == (["a", "b"],)
    assert one(X.display_status_code("x"), X.display_status_name("x"), x="") == ("ING", "예약가능")
    assert one(X.canonical_status("x"), x="FULL") == ("END",)
    assert one(X.synthetic_schedule_no(F.lit("7"), "x"), x="2026-04-01") == ("tf_7_2026-04-01",)


def test_seat_classes(one):
    def cls(remain, total, **kw):
        return one(X.seat_class(F.lit(remain), F.lit(total), **kw), x="")[0]

    assert [cls(0, 10), cls(6, 10), cls(5, 10), cls(2, 10)] == [
        "seat-zero",
        "seat-high",
        "seat-mid",
        "seat-low",
    ]
    assert cls(3, 0) == "seat-high"
    assert cls(3, 0, strict=True) is None
    assert one(X.fill_percent(F.lit(1), F.lit(8)), x="") == (13,)
    assert one(X.seat_status(F.lit(0)), X.seat_status_name(F.lit(2)), x="") == ("FULL", "예약가능")


def test_names(one, recs):
    names = F.array(F.struct(F.lit("a").alias("name")), F.struct(F.lit("b").alias("name")))
    assert one(join_names(names), x="") == ("a, b",)
    df = recs('[{"name":"a"},{"x":1},"b","",3]', '"text"', "12", "0", "false", "[]", "null")
    got = [r[0] for r in df.orderBy("n").select(X.join_variant_names("rec")).collect()]
    assert got == ["a,b", "text", "12", "", "", "", ""]


def test_synonyms_keep_their_order():
    assert expand_synonyms("우럭") == ["우럭", "볼락", "조피볼락"]
    assert expand_synonyms("볼락") == ["볼락", "우럭"]
    assert expand_synonyms("조피") == ["우럭", "볼락", "조피볼락"]
    assert expand_synonyms("왕광어") == ["광어", "넙치"]
    assert expand_synonyms(" cod ") == ["cod"]


def test_page_facts(one):
    html = "<title>[서해] 만선호 - 예약</title> [여수항 만선호] st_uid=48&pa_uid=252"
    assert one(X.page_title("x"), X.page_area("x"), x=html) == ("만선호", "여수")
    own = F.lit("252")
    assert one(X.page_store_id("x", own), x=html) == ("48",)
    assert one(X.page_store_id("x", own), x="go('49', pa_uid=252)") == ("49",)
    assert one(X.page_store_id("x", own), x="type1_ajax(st_uid=50)") == ("50",)
    assert one(X.page_store_id("x", own), x="st_uid=51&pa_uid=9") == (None,)
