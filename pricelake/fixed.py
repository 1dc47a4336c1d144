"""Code lists, labels and coordinates the results depend on."""

from __future__ import annotations

# Product class code -> name.
PRODUCT_CLASSES = {"01": "소매", "02": "도매"}

# Category code -> name.
CATEGORIES = {
    "100": "식량작물",
    "200": "채소류",
    "300": "특용작물",
    "400": "과일류",
    "500": "축산물",
    "600": "수산물",
}

# Retail region code -> (name, latitude, longitude).
REGIONS = {
    "1101": ("서울", 37.5666103, 126.9783882),
    "2100": ("부산", 35.179816, 129.0750223),
    "2200": ("대구", 35.87139, 128.601763),
    "2300": ("인천", 37.4559418, 126.7051505),
    "2401": ("광주", 35.160032, 126.851338),
    "2501": ("대전", 36.3504396, 127.3849508),
    "2601": ("울산", 35.5394773, 129.3112994),
    "3111": ("수원", 37.263476, 127.028646),
    "3211": ("춘천", 37.8813739, 127.7300034),
    "3214": ("강릉", 37.752175, 128.875836),
    "3311": ("청주", 36.6424987, 127.488975),
    "3511": ("전주", 35.824171, 127.14805),
    "3711": ("포항", 36.0190333, 129.3433898),
    "3911": ("제주", 33.4273366, 126.5758344),
    "3113": ("의정부", 37.738083, 127.033753),
    "3613": ("순천", 34.9506984, 127.487243),
    "3714": ("안동", 36.568425, 128.7295375),
    "3814": ("창원", 35.2278771, 128.6818746),
    "3145": ("용인", 37.2412522, 127.1774916),
    "2701": ("세종", 36.4803512, 127.2894325),
    "3112": ("성남", 37.4200267, 127.1267772),
    "3138": ("고양", 37.6583981, 126.8319831),
    "3411": ("천안", 36.815147, 127.113892),
    "3818": ("김해", 35.228574, 128.889322),
}
REGION_NAMES = {code: place[0] for code, place in REGIONS.items()}

# Names for codes outside the lists, and for the nationwide request.
UNKNOWN_CLASS = "미분류"
UNKNOWN_CATEGORY = "미분류"
UNKNOWN_REGION = "기타"
NATIONWIDE_CODE, NATIONWIDE_NAME = "all", "전국"

# Cities with a wholesale market.
WHOLESALE_CITIES = ("서울", "부산", "대구", "광주", "대전")

# Weekday names, Monday first, and the label of an unknown day.
WEEKDAY_NAMES = ("월요일", "화요일", "수요일", "목요일", "금요일", "토요일", "일요일")
UNKNOWN_WEEKDAY = "알수없음"

# Region names in the region feed that are averages, not places.
PSEUDO_REGIONS = ("평균", "평년")

# Category codes of each output segment; codes in no segment are dropped.
SEGMENTS = {
    "main": ("100", "200", "300", "400", "600"),
    "livestock": ("500",),
    "grocery": ("800",),
}

# Market-name suffix of a retail chain, and the two channel names.
CHAIN_SUFFIX = "-유통"
CHAIN_CHANNEL, TRADITIONAL_CHANNEL = "유통", "전통"

# Market categories the organic-price mart may hold.
MARKET_CATEGORIES = ("전문점", "대형마트", "생협", "백화점", "SSM", "직매장")

# Direction codes of the daily price change.
RISE, DROP, KEEP = "1", "0", "2"

# Response codes.
CODE_OK, CODE_NO_DATA = "000", "001"

# Names of the feeds' fields and of the columns they become, in the feeds' order.

# Landing key -> silver column.
PATH_NAMES = {
    "product_cls": "product_cls_cd",
    "country": "country_cd",
    "category": "category_cd",
    "item": "item_cd",
    "kind": "kind_cd",
    "product_rank": "rank_cd",
}
# Product feed field -> silver column.
PRODUCT_NAMES = {
    "product_cls_code": "product_cls_cd",
    "product_cls_name": "product_cls_nm",
    "county_code": "country_cd",
    "county_name": "country_nm",
    "category_code": "category_cd",
    "category_name": "category_nm",
    "productno": "product_no",
    "lastest_day": "res_dt",
    "unit": "product_cls_unit",
    "day1": "base_dt",
    "dpr1": "base_pr",
    "day2": "prev_1d_dt",
    "dpr2": "prev_1d_pr",
    "day3": "prev_1m_dt",
    "dpr3": "prev_1m_pr",
    "day4": "prev_1y_dt",
    "dpr4": "prev_1y_pr",
    "direction": "direction_tp",
    "value": "direction_pct",
}

# Category feed: JSON label field -> silver column, and price field -> silver column.
CATEGORY_LABELS = {
    "item_name": "item_nm",
    "item_code": "item_cd",
    "kind_name": "kind_nm",
    "kind_code": "kind_cd",
    "rank": "rank_nm",
    "rank_code": "rank_cd",
    "unit": "unit",
    "day1": "base_dt",
    "day2": "prev_1d_dt",
    "day3": "prev_1w_dt",
    "day4": "prev_2w_dt",
    "day5": "prev_1m_dt",
    "day6": "prev_1y_dt",
    "day7": "avg_tp",
}
CATEGORY_PRICES = {
    "dpr1": "base_pr",
    "dpr2": "prev_1d_pr",
    "dpr3": "prev_1w_pr",
    "dpr4": "prev_2w_pr",
    "dpr5": "prev_1m_pr",
    "dpr6": "prev_1y_pr",
    "dpr7": "avg_pr",
}

# Fields of one record of the product feed and of the region feed.
PRODUCT_FIELDS = (
    "product_cls_code",
    "product_cls_name",
    "category_code",
    "category_name",
    "productno",
    "lastest_day",
    "productName",
    "unit",
    "day1",
    "dpr1",
    "day2",
    "dpr2",
    "day3",
    "dpr3",
    "day4",
    "dpr4",
    "direction",
    "value",
    "county_code",
    "county_name",
)
REGION_FIELDS = (
    "itemname",
    "kindname",
    "countyname",
    "marketname",
    "yyyy",
    "regday",
    "price",
)
