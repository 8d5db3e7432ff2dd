"""Lookup tables, word lists, labels and patterns that results depend on.

Nothing here is logic.  The tables are small reference data; ``berthline.dims``
turns them into DataFrames, and every operator also accepts a table of the
caller's own in their place.
"""

# --- Fixed values: known boats, (ship name, sub-area, boat id), in match order ---
ENTITY_MAP = [
    ("K세븐호", "중구", 1717),
    ("검은모래호", "여수", 2166),
    ("경진호", "고성", 1992),
    ("경진호", "사천", 2108),
    ("골드로저호", "여수", 1773),
    ("김대영호", "군산", 2238),
    ("나라호", "중구", 2279),
    ("나래호", "창원", 1961),
    ("나폴레옹호", "태안", 451),
    ("노을바다호", "당진", 784),
    ("뉴고니호", "창원", 2090),
    ("뉴벤쿠버호", "거제", 961),
    ("뉴스타호", "태안", 2288),
    ("뉴스타호", "고성", 1998),
    ("뉴해경호", "창원", 2253),
    ("뉴해양호", "서천", 1990),
    ("대성호", "통영", 1756),
    ("대성호", "태안", 2246),
    ("더블케이2호", "사천", 1870),
    ("더블케이호", "사천", 1867),
    ("도리스피싱", "사천", 1496),
    ("돌핀호", "고성", 2375),
    ("돌핀호", "시흥", 1419),
    ("돌핀호", "평택", 2027),
    ("동백호", "홍성", 993),
    ("동백호", "태안", 1558),
    ("동인호", "포항", 2422),
    ("드래곤호", "삼척", 1256),
    ("드래곤호", "여수", 1093),
    ("드래곤호", "군산", 487),
    ("라임호", "통영", 2069),
    ("레드호", "태안", 342),
    ("로아2호", "고흥", 1823),
    ("로아호", "고흥", 1822),
    ("로이스호", "통영", 2301),
    ("로즈마리호", "서귀포", 1597),
    ("만선호", "태안", 64),
    ("몬스터호", "고흥", 732),
    ("몬스터호", "여수", 1896),
    ("미르호", "중구", 1405),
    ("미르호", "고성", 1826),
    ("바다사랑호", "태안", 1373),
    ("베테랑호", "보령", 825),
    ("베테랑호", "포항", 2218),
    ("블랙이글스3호", "고성", 813),
    ("블랙이글스호", "고성", 353),
    ("블랙이글스호", "태안", 1655),
    ("비엔나호", "보령", 2072),
    ("빅토리호", "고흥", 1138),
    ("빅토리호", "태안", 338),
    ("빨강등대호", "시흥", 1202),
    ("서린호", "부산", 2025),
    ("세븐호", "중구", 1980),
    ("수호2호", "고흥", 1899),
    ("신가피싱", "사천", 1334),
    ("씨스타호", "홍성", 1422),
    ("씨스타호", "경주", 1357),
    ("씨스타호", "제주", 2012),
    ("씨헌터호", "서천", 2001),
    ("아시아호", "군산", 155),
    ("아쿠아호", "창원", 1765),
    ("안흥2호", "태안", 2028),
    ("알파호", "통영", 2206),
    ("에스코트호", "경주", 1201),
    ("에이스피싱호", "평택", 1683),
    ("에이스호", "보령", 369),
    ("에이스호", "군산", 1701),
    ("에이스호", "제주", 1991),
    ("에이스호", "여수", 2286),
    ("에이스호", "울진", 2344),
    ("에프원호", "중구", 164),
    ("야호", "여수", 2098),
    ("와일드캣호", "태안", 2118),
    ("용왕호", "군산", 1999),
    ("우정호", "강릉", 2339),
    ("일광호", "고성", 1233),
    ("일출호", "제주", 2079),
    ("자유호", "태안", 2244),
    ("짱구호", "창원", 2101),
    ("청운호", "태안", 2037),
    ("코리아호", "고성", 1993),
    ("킹덤호", "통영", 1430),
    ("킹몬스터호", "여수", 1414),
    ("킹콩2호", "중구", 69),
    ("트라이앵글호", "보령", 1547),
    ("포세이돈호", "강릉", 1621),
    ("포세이돈호", "포항", 2193),
    ("포세이돈호", "군산", 2372),
    ("포세이돈호", "시흥", 831),
    ("포세이돈호", "제주", 1068),
    ("포인트호", "사천", 1334),
    ("하모니호", "태안", 193),
    ("해광호", "보령", 2113),
    ("해밀호", "군산", 2094),
    ("해모수호", "보령", 484),
    ("해모수호", "사천", 1216),
    ("해운호", "거제", 1518),
    ("현대호", "태안", 2223),
    ("현대호", "강릉", 1664),
    ("홀리호", "강릉", 1668),
    ("화인호", "중구", 1145),
    ("황금어장호", "태안", 2074),
    ("황금어장호", "보령", 2074),
    ("싹쓰리호", "강릉", 1198),
    ("싹쓰리호", "포항", 1376),
    ("성용호", "통영", 2205),
]

# --- Fixed values: boat coordinates, (boat id, latitude, longitude) ---
BOAT_COORDS = [
    (64, 36.7456, 126.2979),
    (69, 37.4562, 126.6086),
    (155, 35.9833, 126.5667),
    (164, 37.4705, 126.6163),
    (193, 36.7456, 126.2979),
    (338, 36.7456, 126.2979),
    (342, 36.7456, 126.2979),
    (353, 38.3833, 128.4667),
    (369, 36.3494, 126.5081),
    (451, 36.7456, 126.2979),
    (484, 36.3494, 126.5081),
    (487, 35.9833, 126.5667),
    (731, 34.6141, 127.2868),
    (732, 34.6141, 127.2868),
    (784, 36.9894, 127.0894),
    (813, 38.3833, 128.4667),
    (825, 36.3494, 126.5081),
    (831, 37.3817, 126.8028),
    (961, 34.8783, 128.6219),
    (993, 36.5758, 126.6591),
    (1068, 33.5172, 126.5218),
    (1093, 34.7604, 127.6622),
    (1138, 34.6141, 127.2868),
    (1145, 37.4705, 126.6163),
    (1198, 37.7833, 128.9167),
    (1201, 35.8562, 129.2245),
    (1202, 37.3817, 126.8028),
    (1216, 34.9249, 128.0771),
    (1233, 38.3833, 128.4667),
    (1246, 38.3833, 128.4667),
    (1256, 37.4500, 129.1667),
    (1334, 34.9249, 128.0771),
    (1357, 35.8562, 129.2245),
    (1373, 36.7456, 126.2979),
    (1376, 36.0167, 129.3833),
    (1405, 37.4705, 126.6163),
    (1414, 34.7604, 127.6622),
    (1419, 37.3817, 126.8028),
    (1422, 36.5758, 126.6591),
    (1430, 34.8544, 128.4330),
    (1496, 34.9249, 128.0771),
    (1518, 34.8783, 128.6219),
    (1547, 36.3494, 126.5081),
    (1558, 36.7456, 126.2979),
    (1597, 33.2489, 126.5678),
    (1621, 37.7833, 128.9167),
    (1655, 36.7456, 126.2979),
    (1664, 37.7833, 128.9167),
    (1668, 37.7833, 128.9167),
    (1683, 36.9894, 127.0894),
    (1701, 35.9833, 126.5667),
    (1717, 37.4562, 126.6086),
    (1756, 34.8544, 128.4330),
    (1765, 35.1425, 128.5542),
    (1773, 34.7604, 127.6622),
    (1822, 34.6141, 127.2868),
    (1823, 34.6141, 127.2868),
    (1826, 38.3833, 128.4667),
    (1867, 34.9249, 128.0771),
    (1870, 34.9249, 128.0771),
    (1896, 34.7604, 127.6622),
    (1899, 34.6141, 127.2868),
    (1961, 35.1425, 128.5542),
    (1980, 37.4705, 126.6163),
    (1990, 36.2294, 126.5875),
    (1991, 33.5172, 126.5218),
    (1992, 38.3833, 128.4667),
    (1993, 38.3833, 128.4667),
    (1998, 38.3833, 128.4667),
    (1999, 35.9833, 126.5667),
    (2001, 36.2294, 126.5875),
    (2012, 33.5172, 126.5218),
    (2025, 35.1000, 129.0444),
    (2027, 36.9894, 127.0894),
    (2028, 36.7456, 126.2979),
    (2037, 36.7456, 126.2979),
    (2069, 34.8544, 128.4330),
    (2072, 36.3494, 126.5081),
    (2074, 36.7456, 126.2979),
    (2079, 33.5172, 126.5218),
    (2090, 35.1944, 128.5806),
    (2094, 35.9833, 126.5667),
    (2098, 34.7604, 127.6622),
    (2101, 35.1944, 128.5806),
    (2108, 34.9249, 128.0771),
    (2113, 36.3494, 126.5081),
    (2118, 36.7456, 126.2979),
    (2166, 34.7604, 127.6622),
    (2193, 36.0167, 129.3833),
    (2205, 34.8544, 128.4330),
    (2206, 34.8544, 128.4330),
    (2218, 36.0167, 129.3833),
    (2223, 36.7456, 126.2979),
    (2238, 35.9833, 126.5667),
    (2244, 36.7456, 126.2979),
    (2246, 36.7456, 126.2979),
    (2253, 35.1425, 128.5542),
    (2279, 37.4562, 126.6086),
    (2286, 34.7604, 127.6622),
    (2288, 36.7456, 126.2979),
    (2301, 34.8544, 128.4330),
    (2339, 37.7833, 128.9167),
    (2344, 37.0000, 129.4000),
    (2372, 35.9833, 126.5667),
    (2375, 38.3833, 128.4667),
    (2422, 36.0167, 129.3833),
]

# --- Fixed values: sub-area -> province, in match order ---
AREA_TO_MAIN = [
    ("중구", "인천"),
    ("시흥", "경기"),
    ("안산", "경기"),
    ("화성", "경기"),
    ("평택", "경기"),
    ("태안", "충남"),
    ("보령", "충남"),
    ("홍성", "충남"),
    ("당진", "충남"),
    ("서천", "충남"),
    ("군산", "전북"),
    ("부안", "전북"),
    ("여수", "전남"),
    ("고흥", "전남"),
    ("무안", "전남"),
    ("통영", "경남"),
    ("사천", "경남"),
    ("거제", "경남"),
    ("창원", "경남"),
    ("고성", "경남"),
    ("강릉", "강원"),
    ("동해", "강원"),
    ("삼척", "강원"),
    ("속초", "강원"),
    ("제주", "제주"),
    ("서귀포", "제주"),
    ("포항", "경북"),
    ("울진", "경북"),
    ("경주", "경북"),
    ("부산", "부산"),
    ("울산", "울산"),
    ("완도", "전남"),
    ("신안", "전남"),
]
OTHER_AREA = "기타"

# --- Fixed values: species synonyms, (term, expansion), in match order ---
SPECIES_SYNONYMS = [
    ("쭈꾸미", ["쭈꾸미", "주꾸미"]),
    ("주꾸미", ["쭈꾸미", "주꾸미"]),
    ("광어", ["광어", "넙치"]),
    ("넙치", ["광어", "넙치"]),
    ("우럭", ["우럭", "볼락", "조피볼락"]),
    ("볼락", ["볼락", "우럭"]),
    ("참돔", ["참돔", "도미"]),
    ("도미", ["참돔", "도미"]),
    ("삼치", ["삼치", "고등어"]),
    ("학꽁치", ["학꽁치", "공치"]),
    ("공치", ["학꽁치", "공치"]),
]

# --- Fixed values: record field aliases, first non-null wins ---
# The last entry of the remain, method, area and port lists is the unified
# document's own field name, so that our own output reads back whole.
FIELD_ALIASES = {
    "ship_name": ["name", "ship_name"],
    "area_name": ["area_name", "area_main"],
    "port_name": ["port_name", "area_sub"],
    "fishing_date": ["sdate", "fishing_date", "date"],
    "depart_time": ["stime", "depart_time", "start_time"],
    "return_time": ["etime", "return_time", "end_time"],
    "fish_types": ["fish_type", "fish_types", "fishing_type"],
    "fishing_methods": ["fishing_method", "fishing_methods", "method"],
    "price": ["price"],
    "total_seats": ["embarkation_num", "total_seats", "capacity"],
    "reserved_seats": ["reservation_end_num", "reserved_seats", "reserved"],
    "remain_seats": ["remain_embarkation_num", "remain_seats", "available", "remain"],
    "status_code": ["schedule_status_code", "status_code", "status"],
    "status_name": ["schedule_status_name", "status_name"],
    "schedule_no": ["ship_schedule_no", "schedule_no", "schedule_id"],
}

# --- Fixed values: keys that may hold the records of a landed document ---
DOCUMENT_KEYS = ["data", "records", "ships", "items", "results"]

# --- Fixed values: ad sheet headers by field ---
AD_SHEET_HEADERS = {
    "report_date": "날짜",
    "impressions": "노출수",
    "clicks": "클릭수",
    "conversions": "전환수",
    "ad_spend": "광고비",
    "revenue": "광고기여매출",
    "roas": "ROAS",
    "ctr": "CTR",
    "cvr_ad": "전환율",
}

# --- Fixed values: labels ---
PRICE_UNIT = "원"
PRICE_ON_REQUEST = "전화문의"
MONTH_SUFFIX = "월"
WEEKDAYS = ["일", "월", "화", "수", "목", "금", "토"]  # Sunday first
STATUS_OPEN = "ING"
STATUS_SOLD_OUT = "END"
STATUS_FULL = "FULL"
STATUS_OPEN_NAME = "예약가능"
STATUS_FULL_NAME = "예약마감"
LISTING_SOURCE = "sunsang24"
CALENDAR_SOURCE = "thefishing"
RUN_OK = "성공"
RUN_FAILED = "실패"

# --- Fixed values: advertising channel names ---
CHANNEL_META = "Meta Ads"
CHANNEL_GOOGLE = "Google Ads"
CHANNEL_NAVER = "네이버 쇼핑"

# --- Fixed values: figures shown when there is no data (opt-in only) ---
DEFAULT_KPI = {
    "gmv_man": 390.0,
    "gmv_wow_pct": 12.0,
    "bookings": 400,
    "bookings_wow_pct": 18.0,
    "cvr_pct": 2.9,
    "ships": 765,
    "members": 247000,
    "total_ad_spend": 0.0,
}
DEFAULT_CHANNELS = [
    ("Meta Ads", 0.0, 48.0),
    ("Google Ads", 0.0, 28.0),
    ("유기적(SEO·직접)", 0.0, 16.0),
    ("네이버 키워드", 0.0, 8.0),
]

# --- Fixed values: patterns for directory pages ---
ID_LINK_PATTERN = r"""href=["'].*?uid=(\d+)["']"""
TITLE_PATTERN = r"<title>(?:\[.+?\])?\s*(.+?)\s*[-|]"
AREA_PATTERN = r"\[([가-힣]+항?)\s+([가-힣]+호?)\]"
AREA_SUFFIX = "항"
STORE_ID_PATTERN_LINK = r"st_uid=(\d+)&pa_uid="  # page id follows
STORE_ID_PATTERN_CALL = r"'(\d+)'[,\s]*pa_uid.*?"  # page id follows
STORE_ID_PATTERN_AJAX = r"type1_ajax.*?st_uid=(\d+)"

# --- Fixed values: commission, page sizes, limits ---
TAKE_RATE = "0.03"
FEED_PAGE_ROWS = 30
SHORT_PAGE_ROWS = 10
LIST_PAGE_ROWS = 50
DIRECTORY_MAX_IDS = 60
TREND_MONTHS = 24
AD_TREND_MONTHS = 12
FUZZY_TOLERANCE = 0.35
