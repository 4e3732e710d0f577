"""Queries of the scalar functions: text, numbers, dates and hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import dates, hours, numbers, text, values

from .base import HAVERSINE_SQL, SEED, TOKENS_SQL, jaccard_sql, query, scalar, table

K = "c_custkey"
NUM = f"CAST({K} * 7919 % 100000000 AS STRING)"

# Names -----------------------------------------------------------------------------------------------------------
scalar("T01_name_tokens", "concat(p_name, ' & ', p_brand, ', ', p_type)", {"tokens": (lambda c: F.array_join(F.array_sort(text.name_tokens(c)), " "), f"array_to_string(list_sort({TOKENS_SQL.format('raw')}), ' ')")}, "part", "p_partkey")


@query("T02_name_match", f"WITH s AS ({SEED.sql}), t AS (SELECT pos, {TOKENS_SQL.format('business_name')} AS a, {TOKENS_SQL.format(chr(39) + 'Red Widget Cafe' + chr(39))} AS b FROM s) SELECT pos, round({jaccard_sql('a', 'b')}, 6) AS score FROM t")
def name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SEED.frame(spark, sf_dir).select("pos", F.round(text.name_match(F.col("business_name"), F.lit("Red Widget Cafe")), 6).alias("score"))


# Phones and URLs -------------------------------------------------------------------------------------------------
PHONE = (
    f"CASE {K} % 8 WHEN 0 THEN concat('+880 17', lpad({NUM}, 8, '0')) WHEN 1 THEN concat('01', CAST({K} % 10 AS STRING), '-', lpad({NUM}, 8, '0')) "
    f"WHEN 2 THEN concat('02 ', lpad({NUM}, 7, '0')) WHEN 3 THEN concat('00880 1712 ', lpad({NUM}, 6, '5')) WHEN 4 THEN 'N/A' WHEN 5 THEN NULL WHEN 6 THEN {NUM} ELSE concat('(880) ', {NUM}, ' ext') END"
)
DUCK_PHONE = (
    "(SELECT CASE WHEN regexp_full_match(n, '1[3-9][0-9]{8}|2[0-9]{7,8}') THEN '+880' || n END FROM (SELECT ltrim(CASE WHEN starts_with(d, '00880') THEN substr(d, 6) "
    "WHEN starts_with(d, '880') THEN substr(d, 4) ELSE d END, '0') AS n FROM (SELECT ltrim(regexp_replace({0}, '[^0-9+]', '', 'g'), '+') AS d)))"
)
scalar("T03_norm_bd_phone", PHONE, {"phone": (text.norm_bd_phone, DUCK_PHONE.replace("{0}", "raw"))})


@query(
    "T04_find_phones",
    "WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, '') || ' call 017' || lpad(CAST(doc_id * 7919 % 100000000 AS VARCHAR), 8, '0') || ' or +880 2 8834567.', '\\+?[0-9]{2,}(?:[\\s\\-().]{1,2}[0-9]{2,}){0,4}') AS spans FROM documents), "
    "u AS (SELECT doc_id, unnest(spans) AS s, generate_subscripts(spans, 1) AS i FROM d), n AS (SELECT doc_id, i, " + DUCK_PHONE.replace("{0}", "s") + " AS p FROM u), "
    "f AS (SELECT doc_id, p, min(i) AS i FROM n WHERE p IS NOT NULL GROUP BY 1, 2) SELECT doc_id, string_agg(p, ',' ORDER BY i) AS phones FROM f GROUP BY 1",
)
def find_phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = F.concat(F.coalesce("text", F.lit("")), F.lit(" call 017"), F.lpad((F.col("doc_id") * 7919 % 100000000).cast("string"), 8, "0"), F.lit(" or +880 2 8834567."))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.find_phones(told), ",").alias("phones"))


DUCK_URL = "CASE WHEN starts_with({0}, 'http') AND regexp_matches(split_part({0}, '#', 1), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]') THEN rtrim(split_part(split_part({0}, '#', 1), '?', 1), '/') END"


@query("T05_clean_url", f"SELECT page_id, {DUCK_URL.format('url')} AS cleaned FROM pages")
def clean_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.clean_url(F.col("url")).alias("cleaned"))


scalar(
    "T05_clean_url_variant",
    f"CASE {K} % 6 WHEN 0 THEN concat('http://x', CAST({K} AS STRING), '.example.com/a?') WHEN 1 THEN concat('http://x.example.com/', CAST({K} AS STRING), '//?q=1#t') WHEN 2 THEN c_name WHEN 3 THEN concat('http:///', c_name) WHEN 4 THEN concat('https://y', CAST({K} AS STRING), '.example.com/?#z') ELSE NULL END",
    {
        "plain": (text.clean_url, "CASE WHEN regexp_matches(raw, '^https?://[^/?#]') THEN regexp_replace(regexp_extract(raw, '^[^?#]*'), '/+$', '') END"),
        "bare_query": (lambda c: text.clean_url(c, keep_bare_query=True), "CASE WHEN regexp_matches(raw, '^https?://[^/?#]') THEN CASE WHEN regexp_matches(raw, '^[^?#]*[?](#|$)') THEN regexp_extract(raw, '^[^#]*') ELSE regexp_replace(regexp_extract(raw, '^[^?#]*'), '/+$', '') END END"),
    },
)
scalar("T06_slugify", "concat(' ', p_name, ' / ', p_brand, ' ')", {"slug": (text.slugify, "coalesce(nullif(trim(regexp_replace(lower(trim(raw)), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unknown')")}, "part", "p_partkey")
scalar("T07_file_slug", "concat(p_name, ' #', p_brand, ' (', p_type, ') - ', p_name)", {"slug": (text.file_slug, "left(regexp_replace(raw, '[^A-Za-z0-9]', '_', 'g'), 40)")}, "part", "p_partkey")
scalar(
    "T08_collapse",
    "coalesce(text, '')",
    {f"t{n}": (lambda c, n=n: text.collapsed(c, n), f"left(trim(regexp_replace(raw, '\\s+', ' ', 'g')), {n})") for n in (600, 450, 80)},
    "documents",
    "doc_id",
)
scalar(
    "T09_price_level",
    f"CASE {K} % 3 WHEN 0 THEN concat('Price range, ৳', CAST({K} % 900 AS STRING), '–1,', lpad(CAST({K} % 1000 AS STRING), 3, '0'), ' per person, Reported by 78 people') WHEN 1 THEN ' Moderate ' ELSE concat('Tk ', CAST({K} AS STRING), '-', CAST({K} + 5 AS STRING)) END",
    {
        "level": (
            text.clean_price_level,
            "CASE k % 3 WHEN 0 THEN '৳' || (k % 900) || '–1,' || lpad((k % 1000)::VARCHAR, 3, '0') || ' per person' WHEN 1 THEN 'Moderate' ELSE 'k ' || k || '-' || (k + 5) END",
        )
    },
)
scalar("T10_label_strip", f"concat('Address: House  ', CAST({K} AS STRING), ' ')", {"label": (lambda c: text.without_label(c, "Address:"), "'House ' || k")})
scalar(
    "T11_social_url",
    f"concat('<a href=\"https://www.facebook.com/', CASE {K} % 3 WHEN 0 THEN concat('place.', CAST({K} AS STRING), '/?x=1') WHEN 1 THEN 'sharer/u' ELSE concat('p-', CAST({K} AS STRING)) END, '\">f</a> https://instagram.com/', CASE {K} % 2 WHEN 0 THEN 'p/1' ELSE concat('cafe_', CAST({K} AS STRING), '/') END)",
    {
        "facebook": (text.facebook_url, "CASE k % 3 WHEN 0 THEN 'https://www.facebook.com/place.' || k WHEN 2 THEN 'https://www.facebook.com/p-' || k END"),
        "instagram": (text.instagram_url, "CASE WHEN k % 2 = 1 THEN 'https://instagram.com/cafe_' || k END"),
    },
)
scalar(
    "T12_url_coords",
    f"CASE {K} % 4 WHEN 0 THEN concat('/@1.5,2.5,17z/data=!3d23.', lpad(CAST({K} % 1000 AS STRING), 3, '0'), '!4d90.25') WHEN 1 THEN concat('/@23.', CAST({K} + 1 AS STRING), ',90.75,17z') WHEN 2 THEN concat('!4d-90.5!x!3d', CAST({K} AS STRING), '.125') ELSE 'none' END",
    {
        "latitude": (lambda c: text.url_coords(c)["latitude"], "CASE k % 4 WHEN 0 THEN CAST('23.' || lpad((k % 1000)::VARCHAR, 3, '0') AS DOUBLE) WHEN 1 THEN CAST('23.' || (k + 1) AS DOUBLE) WHEN 2 THEN k + 0.125 END"),
        "longitude": (lambda c: text.url_coords(c)["longitude"], "CASE k % 4 WHEN 0 THEN CAST(90.25 AS DOUBLE) WHEN 1 THEN CAST(90.75 AS DOUBLE) WHEN 2 THEN CAST(-90.5 AS DOUBLE) END"),
    },
)
scalar("T13_place_id", f"concat('data=!4m5!1s0x3755c', CAST({K} AS STRING), ':0xaB', CAST({K} % 7 AS STRING), '!8m2')", {"place_id": (text.place_id, "'0x3755c' || k || ':0xaB' || (k % 7)")})


@query("T14_search_url", f"WITH s AS ({SEED.sql}) SELECT pos, 'https://www.google.com/maps/search/' || replace(replace(url_encode(business_name || ', ' || coalesce(sub_area, area, 'Dhaka') || ', Dhaka, Bangladesh'), '%20', '+'), '%2C', '%2C') AS url FROM s")
def search_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = SEED.frame(spark, sf_dir)
    built = text.search_url(F.col("business_name"), F.coalesce("sub_area", "area"), F.col("latitude"), F.col("longitude"))
    return s.select("pos", F.substring_index(built, "/@", 1).alias("url"))


STATUS = (
    f"CASE {K} % 7 WHEN 0 THEN concat(c_name, ' is Permanently closed') WHEN 1 THEN concat('temporarily CLOSED until ', CAST({K} AS STRING)) WHEN 2 THEN concat(c_name, ' has moved') WHEN 3 THEN concat('Temporarily unavailable ', c_name) "
    f"WHEN 4 THEN concat('closed permanently; ', c_name, ' temporarily closed') WHEN 5 THEN concat('open, ', c_name) ELSE NULL END"
)
_LOW = "lower(coalesce(raw, ''))"
scalar(
    "T15_status_text",
    STATUS,
    {
        "package": (text.status_of, f"CASE WHEN regexp_matches({_LOW}, 'permanently closed|closed permanently') THEN 'PERMANENTLY_CLOSED' WHEN contains({_LOW}, 'temporarily closed') THEN 'TEMPORARILY_CLOSED' END"),
        "moved": (
            lambda c: text.status_of(c, "moved"),
            f"CASE WHEN regexp_matches({_LOW}, 'permanently closed|closed permanently') THEN 'PERMANENTLY_CLOSED' WHEN regexp_matches({_LOW}, 'temporarily (closed|unavailable)') THEN 'TEMPORARILY_CLOSED' WHEN regexp_matches({_LOW}, 'has moved|moved to a new location') THEN 'MOVED' END",
        ),
        "tag": (lambda c: text.status_of(c, "tag"), f"CASE WHEN contains({_LOW}, 'permanently closed') THEN 'Permanently Closed' WHEN contains({_LOW}, 'temporarily closed') THEN 'Temporarily Closed' END"),
        "with_head": (lambda c: text.detected_status(c, F.lit("Permanently closed for good")), f"CASE WHEN contains({_LOW}, 'temporarily closed') AND NOT regexp_matches({_LOW}, 'permanently closed|closed permanently') THEN 'TEMPORARILY_CLOSED' ELSE 'PERMANENTLY_CLOSED' END"),
    },
)
scalar(
    "T17_menu_item",
    f"CASE {K} % 4 WHEN 0 THEN concat('Latte  -  ৳ ', CAST({K} AS STRING), '.50') WHEN 1 THEN concat('Tk. 1,2', lpad(CAST({K} % 100 AS STRING), 2, '0'), ' Biryani, large') WHEN 2 THEN concat('Tea', CAST({K} AS STRING)) ELSE '৳ 20' END",
    {
        "item": (lambda c: text.menu_item(c)["item"], "CASE k % 4 WHEN 0 THEN 'Latte' WHEN 1 THEN 'Biryani, large' WHEN 2 THEN 'Tea' || k END"),
        "price_bdt": (lambda c: text.menu_item(c)["price_bdt"], "CASE k % 4 WHEN 0 THEN k + 0.5 WHEN 1 THEN CAST(1200 + k % 100 AS DOUBLE) END"),
    },
)
scalar("T20_review_length", "coalesce(text, '')", {f"at_least_{n}": (lambda c, n=n: F.length(text.collapsed(c)) >= n, f"length(trim(regexp_replace(raw, '\\s+', ' ', 'g'))) >= {n}") for n in (15, 25, 30)}, "documents", "doc_id")
scalar("T21_stars", f"CASE WHEN {K} % 3 = 0 THEN concat('no stars ', CAST({K} % 10 * 6 AS STRING)) ELSE concat(CAST({K} AS STRING), ' of 5 stars') END", {"stars": (text.stars, "nullif(regexp_extract(raw, '[1-5]'), '')::BIGINT")})
scalar(
    "T23_brand_contact",
    f"concat('Phone: +880 1', CAST({K} AS STRING), '-(22)\nFloor 2')",
    {"phone": (text.brand_phone, "'+880 1' || k || '-(22)' || chr(10) || ' 2'"), "address": (text.brand_address, "'Phone: +880 1' || k || '-(22), Floor 2'")},
)
scalar(
    "T27_fallback_text",
    f"CASE {K} % 3 WHEN 0 THEN concat(' ', substr(c_name, 1, CAST({K} % 5 AS INT)), '  ') WHEN 1 THEN concat('  ', c_name) ELSE NULL END",
    {"chosen": (lambda c: text.fallback_text(c, F.lit(" second choice "), least=3), "CASE WHEN length(trim(raw)) >= 3 THEN trim(raw) ELSE 'second choice' END")},
)
scalar(
    "T28_place_name",
    f"CASE {K} % 3 WHEN 0 THEN concat('Results| ', c_name, ' |Cafe A') WHEN 1 THEN ' |n/a|Google Maps' ELSE concat(c_name, '|X') END",
    {"name": (lambda c: text.place_name(F.split(c, r"\|")), "coalesce(list_filter(list_transform(string_split(raw, '|'), lambda x: trim(x)), lambda x: lower(x) NOT IN ('', 'results', 'n/a', 'google maps', 'search results'))[1], 'N/A')")},
)
scalar(
    "F06_brand",
    f"CASE {K} % 7 WHEN 0 THEN concat('Agora Super ', c_name) WHEN 1 THEN concat(c_name, ' আগোরা') WHEN 2 THEN concat('agora ', c_name) WHEN 3 THEN 'Results' WHEN 4 THEN concat(c_name, ' OUTLET of AGORA') WHEN 5 THEN c_name ELSE NULL END",
    {"target": (lambda c: text.is_brand(c, "Agora", ("আগোরা",), ("super", "outlet")), "coalesce(contains(raw, 'আগোরা') OR (contains(lower(raw), 'agora') AND regexp_matches(lower(raw), 'super|outlet')), FALSE)")},
)
scalar("F07_ilike", "concat(p_name, ' ', p_brand)", {"hit": (lambda c: c.ilike("%RED w%"), "raw ILIKE '%RED w%'")}, "part", "p_partkey")
EMPTY = f"CASE {K} % 8 WHEN 0 THEN NULL WHEN 1 THEN repeat(' ', CAST({K} % 50 AS INT)) WHEN 2 THEN 'N/A' WHEN 3 THEN CAST({K} % 10 AS STRING) WHEN 4 THEN 'nan' WHEN 5 THEN concat(repeat(' ', CAST({K} % 50 AS INT)), 'n/a ') ELSE c_name END"
scalar(
    "F11_is_empty",
    EMPTY,
    {
        "package": (values.is_empty, "raw IS NULL OR upper(trim(raw)) IN ('', 'N/A')"),
        "plain": (lambda c: values.is_empty(c, ()), "raw IS NULL OR trim(raw) = ''"),
        "text_nulls": (lambda c: values.is_empty(c, ("NAN", "NONE", "NULL")), "raw IS NULL OR lower(trim(raw)) IN ('', 'nan', 'none', 'null')"),
    },
)

# Numbers ---------------------------------------------------------------------------------------------------------
COUNT = (
    f"CASE {K} % 7 WHEN 0 THEN concat(CAST({K} AS STRING), ' reviews') WHEN 1 THEN concat('1,', lpad(CAST({K} % 1000 AS STRING), 3, '0')) WHEN 2 THEN concat(CAST({K} % 9 + 1 AS STRING), '.5K reviews') "
    f"WHEN 3 THEN '3M' WHEN 4 THEN 'N/A' WHEN 5 THEN NULL ELSE concat(CAST({K} AS STRING), ' min') END"
)
scalar(
    "N02_parse_count",
    COUNT,
    {
        "value": (lambda c: numbers.parse_count(c)["value"], "CAST(CASE k % 7 WHEN 0 THEN k WHEN 1 THEN 1000 + k % 1000 WHEN 2 THEN (k % 9 + 1) * 1000 + 500 WHEN 3 THEN 3000000 WHEN 6 THEN k * 1000000 END AS BIGINT)"),
        "approximate": (lambda c: numbers.parse_count(c)["approximate"], "k % 7 IN (2, 3, 6)"),
        "word_value": (lambda c: numbers.parse_count(c, True)["value"], "CAST(CASE k % 7 WHEN 0 THEN k WHEN 1 THEN 1000 + k % 1000 WHEN 2 THEN (k % 9 + 1) * 1000 + 500 WHEN 3 THEN 3000000 WHEN 6 THEN k END AS BIGINT)"),
    },
)
scalar("N03_plain_count", COUNT, {"value": (numbers.parse_plain_count, "CAST(CASE k % 7 WHEN 0 THEN k WHEN 1 THEN 1000 + k % 1000 WHEN 2 THEN k % 9 + 1 WHEN 3 THEN 3 WHEN 6 THEN k END AS BIGINT)")})
scalar(
    "N04_parse_rating",
    f"CASE {K} % 5 WHEN 0 THEN concat('4,', CAST({K} % 10 AS STRING), ' stars') WHEN 1 THEN '5.7' WHEN 2 THEN '0' WHEN 3 THEN 'rated 4.65' ELSE concat(CAST({K} % 6 AS STRING), ' of 5') END",
    {"rating": (numbers.parse_rating, "CASE k % 5 WHEN 0 THEN 4 + (k % 10) / 10.0 WHEN 3 THEN 4.0 WHEN 4 THEN CASE WHEN k % 6 = 0 THEN NULL ELSE (k % 6)::DOUBLE END END")},
)
scalar(
    "N05_to_float",
    f"CASE {K} % 6 WHEN 0 THEN concat(' 1,', lpad(CAST({K} % 1000 AS STRING), 3, '0'), '.25 ') WHEN 1 THEN '1d' WHEN 2 THEN 'NaN' WHEN 3 THEN 'inf' WHEN 4 THEN concat('-', CAST({K} AS STRING), 'e-2') ELSE 'x' END",
    {"value": (numbers.number, "CASE k % 6 WHEN 0 THEN 1000 + k % 1000 + 0.25 WHEN 4 THEN CAST('-' || k || 'e-2' AS DOUBLE) END")},
)
scalar(
    "N06_rating_count_text",
    f"concat('Open now ', CASE {K} % 2 WHEN 0 THEN concat('4.', CAST({K} % 10 AS STRING), ' (1,', lpad(CAST({K} % 1000 AS STRING), 3, '0'), ') cafe') ELSE 'no rating' END)",
    {
        "rating": (lambda c: numbers.rating_and_count(c)["rating"], "CASE WHEN k % 2 = 0 THEN 4 + (k % 10) / 10.0 END"),
        "reviews": (lambda c: numbers.rating_and_count(c)["count"], "CASE WHEN k % 2 = 0 THEN 1000 + k % 1000 END::BIGINT"),
    },
)
scalar(
    "N07_price_bdt",
    f"CASE {K} % 4 WHEN 0 THEN concat('৳', CAST({K} AS STRING), '.5') WHEN 1 THEN concat('bdt ', CAST({K} AS STRING)) WHEN 2 THEN 'TK.1,250' ELSE '$5' END",
    {"price": (numbers.price_bdt, "CASE k % 4 WHEN 0 THEN k + 0.5 WHEN 1 THEN k::DOUBLE WHEN 2 THEN 1250.0 END")},
)


@query("N01_haversine", f"WITH s AS ({SEED.sql}), h AS (SELECT 23.7806e0 AS latitude, 90.4193e0 AS longitude) SELECT pos, round({HAVERSINE_SQL.format(a='s', b='h')}, 3) AS metres FROM s, h")
def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SEED.frame(spark, sf_dir).select("pos", F.round(numbers.haversine_m(F.col("latitude"), F.col("longitude"), F.lit(23.7806), F.lit(90.4193)), 3).alias("metres"))


@query("N08_round_even", "SELECT p_partkey, round_even((p_partkey % 40) / 16.0, 3) AS r3, round_even((p_partkey % 40) / 2.0, 0) AS r0 FROM part")
def round_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 40
    return table(spark, sf_dir, "part").select("p_partkey", numbers.round_even(k / 16.0, 3).alias("r3"), numbers.round_even(k / 2.0).alias("r0"))


# Dates -----------------------------------------------------------------------------------------------------------
@query("D01_iso_utc", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y-%m-%d') AS day_key FROM events")
def iso_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", dates.iso_utc(F.col("ts")).alias("iso"), dates.day_key(F.col("ts")).alias("day_key"))


_UNITS = ("second", "minute", "hour", "day", "week", "month", "year")
_UNIT = f"CASE {K} % 7 " + " ".join(f"WHEN {i} THEN '{u}'" for i, u in enumerate(_UNITS)) + " END"
scalar(
    "D02_relative_time",
    f"CASE {K} % 5 WHEN 0 THEN concat(' a ', {_UNIT}, ' ago ') WHEN 1 THEN 'yesterday' WHEN 2 THEN NULL ELSE concat(CAST({K} % 30 AS STRING), ' ', {_UNIT}, 's ago') END",
    {
        "raw": (lambda c: dates.relative_time(c, F.to_timestamp(F.lit("2026-09-20 00:30:00")))["raw"], "trim(raw)"),
        "day": (
            lambda c: dates.relative_time(c, F.to_timestamp(F.lit("2026-09-20 00:30:00")))["day"].cast("string"),
            "CASE WHEN k % 5 IN (0, 3, 4) THEN strftime(TIMESTAMP '2026-09-20 00:30:00' - to_seconds(CASE WHEN k % 5 = 0 THEN 1 ELSE k % 30 END * (CASE k % 7 WHEN 0 THEN 1 WHEN 1 THEN 60 WHEN 2 THEN 3600 WHEN 3 THEN 86400 WHEN 4 THEN 604800 WHEN 5 THEN 2592000 ELSE 31536000 END)), '%Y-%m-%d') END",
        ),
    },
)
scalar(
    "S08_run_stamp",
    f"CASE WHEN {K} % 4 = 0 THEN 'raw/other' ELSE concat('raw/run_202401', lpad(CAST({K} % 31 + 1 AS STRING), 2, '0'), '_', lpad(CAST({K} % 24 AS STRING), 2, '0'), '3015') END",
    {"run_at": (lambda c: dates.run_stamp(c).cast("string"), "CASE WHEN k % 4 <> 0 THEN '2024-01-' || lpad((k % 31 + 1)::VARCHAR, 2, '0') || ' ' || lpad((k % 24)::VARCHAR, 2, '0') || ':30:15' END")},
)

# Hours -----------------------------------------------------------------------------------------------------------
_H = f"CAST({K} % 11 + 1 AS STRING)"
scalar(
    "H01_canonical_day",
    f"concat(repeat('.', CAST({K} % 40 AS INT)), CASE {K} % 8 WHEN 0 THEN 'saturday' WHEN 1 THEN 'SUN' WHEN 2 THEN 'Monday:' WHEN 3 THEN 'tues' WHEN 4 THEN 'Wed ' WHEN 5 THEN 'thurs.' WHEN 6 THEN 'Friday' ELSE 'Funday' END, CAST({K} AS STRING))",
    {"day": (hours.canonical_day, "CASE regexp_replace(lower(raw), '[^a-z]', '', 'g') WHEN 'saturday' THEN 'Sat' WHEN 'sun' THEN 'Sun' WHEN 'monday' THEN 'Mon' WHEN 'tues' THEN 'Tue' WHEN 'wed' THEN 'Wed' WHEN 'thurs' THEN 'Thu' WHEN 'friday' THEN 'Fri' END")},
)
_HH = "lpad((k % 11 + 1)::VARCHAR, 2, '0')"
_PM = "lpad((k % 11 + 13)::VARCHAR, 2, '0')"
scalar(
    "H03_parse_span",
    f"CASE {K} % 6 WHEN 0 THEN concat({_H}, ' AM–', {_H}, ':30 PM') WHEN 1 THEN concat({_H}, '–', {_H}, ' pm') WHEN 2 THEN '10:00 - 22:00' WHEN 3 THEN '25–26' WHEN 4 THEN '9 AM-10 PM-3 PM' ELSE '0-0' END",
    {"span": (hours.parse_span, f"CASE k % 6 WHEN 0 THEN {_HH} || ':00-' || {_PM} || ':30' WHEN 1 THEN {_PM} || ':00-' || {_PM} || ':00' WHEN 2 THEN '10:00-22:00' END")},
)
scalar(
    "H02_clock",
    f"concat({_H}, ':05', CASE {K} % 3 WHEN 0 THEN ' AM' WHEN 1 THEN ' PM' ELSE '' END, ' - 11:59 PM')",
    {"span": (hours.parse_span, f"CASE k % 3 WHEN 0 THEN {_HH} ELSE {_PM} END || ':05-23:59'")},
)
scalar(
    "H04_canonical_hours",
    f"CASE {K} % 9 WHEN 0 THEN concat('5–7 PM, 8–', {_H}, ' PM') WHEN 1 THEN 'Open 24 hours' WHEN 2 THEN ' Closed. ' WHEN 3 THEN 'N/A (Check Maps)' WHEN 4 THEN 'Bakery' WHEN 5 THEN '9 AM–1 PM and 3 PM–11 PM' WHEN 6 THEN NULL WHEN 7 THEN '10:00-22:00; ' ELSE '9 AM–10 PM, later' END",
    {"value": (hours.canonical_hours, f"CASE k % 9 WHEN 0 THEN '17:00-19:00, 20:00-' || {_PM} || ':00' WHEN 1 THEN '00:00-24:00' WHEN 2 THEN 'closed' WHEN 5 THEN '09:00-13:00, 15:00-23:00' WHEN 7 THEN '10:00-22:00' END")},
)
_MM = f"lpad(CAST({K} % 60 AS STRING), 2, '0')"
_MIN = "lpad((k % 60)::VARCHAR, 2, '0')"
_WEEK = f"concat('Hours: Monday ', {_H}, ':', {_MM}, ' AM–10 PM; Sunday: Closed; Friday Open 24 hours, monday 1–2 PM; Funday 1–2 PM')"
scalar("H06_hours_in_text", _WEEK, {"week": (lambda c: F.to_json(hours.hours_in_text(c)), f"'{{\"Sun\":\"closed\",\"Mon\":\"' || {_HH} || ':' || {_MIN} || '-22:00\",\"Fri\":\"00:00-24:00\"}}'")}, much_work=True)
scalar(
    "H07_normalized_hours",
    f"concat({_H}, ':', {_MM})",
    {
        "schedule": (
            lambda c: F.to_json(hours.normalized_hours(F.create_map(F.lit("monday"), F.concat(c, F.lit(" AM–10 PM")), F.lit("sat"), F.lit("Closed"), F.lit("x"), F.lit("1-2 PM"), F.lit("tue"), F.lit("ask at counter"), F.lit("sun"), F.lit("N/A")))["schedule"]),
            f"'{{\"Sat\":\"closed\",\"Mon\":\"' || {_HH} || ':' || {_MIN} || '-22:00\",\"Tue\":\"ask at counter\"}}'",
        ),
        "notes": (lambda c: F.array_join(hours.normalized_hours(F.create_map(F.lit("tue"), F.concat(F.lit("ask "), c)))["notes"], ";"), "'Tue: kept raw value ''ask ' || raw || ''''"),
    },
)
scalar(
    "H05_ordered_week",
    "c_name",
    {"week": (lambda c: F.to_json(hours.ordered_week(F.create_map(F.lit("Fri"), c, F.lit("Sat"), F.lit("a"), F.lit("Xyz"), F.lit("b")))), "'{\"Sat\":\"a\",\"Fri\":\"' || raw || '\"}'")},
)
scalar("H09_display_hours", f"concat(' ', {_H}, ':', {_MM}, ' a.m.—10  p.m ,')", {"shown": (hours.display_hours, "(k % 11 + 1) || ':' || lpad((k % 60)::VARCHAR, 2, '0') || ' AM. – 10 PM '")})
scalar("H10_ampm", f"CASE WHEN {K} % 5 = 0 THEN 'x ' ELSE concat(CAST({K} % 25 AS STRING), ':', lpad(CAST({K} % 60 AS STRING), 2, '0')) END", {"shown": (hours.hhmm_to_ampm, "CASE WHEN k % 5 = 0 THEN 'x' ELSE (CASE WHEN k % 25 % 12 = 0 THEN 12 ELSE k % 25 % 12 END) || ':' || lpad((k % 60)::VARCHAR, 2, '0') || CASE WHEN k % 25 < 12 OR k % 25 = 24 THEN ' AM' ELSE ' PM' END END")})
scalar("H14_enough_days", _WEEK, {"three": (lambda c: hours.enough_days(hours.hours_in_text(c), 3), "TRUE"), "five": (lambda c: hours.enough_days(hours.hours_in_text(c)), "FALSE")}, much_work=True)
_TWO = _MM
_SHOWN = "(k % 11 + 1) || ':' || lpad((k % 60)::VARCHAR, 2, '0') || ' AM – 10:30 PM'"
_DAYS_SQL = "list_transform({0}, lambda d: chr(34) || d || chr(34) || ':' || chr(34) || {1} || chr(34))"


def week_sql(*parts: tuple[list[str], str]) -> str:
    """SQL for the JSON text of a week: (days, SQL of their value) in the order of the text."""
    return "'{' || array_to_string(" + (" || ".join(_DAYS_SQL.format(days, value) for days, value in parts) if parts else "[]") + ", ',') || '}'"


_ALL = list(hours.WEEK_ISO)
scalar(
    "H11_osm_hours",
    f"CASE {K} % 8 WHEN 0 THEN concat('Mo-Fr ', {_H}, ':', {_TWO}, '-22:30; Sa,Su 08:00-23:00') WHEN 1 THEN '24/7' WHEN 2 THEN concat('Mo off; We ', {_H}, ':', {_TWO}, '-22:30') WHEN 3 THEN concat('Mo-Su ', {_H}, ':', {_TWO}, '-22:30; PH off') WHEN 4 THEN NULL "
    f"WHEN 5 THEN concat('Sa-Mo ', {_H}, ':', {_TWO}, '-22:30, 23:00-23:30; Mo closed') WHEN 6 THEN concat('sometimes ', {_H}) ELSE concat({_H}, ':', {_TWO}, '-22:30') END",
    {
        name: (
            lambda c, compat=compat: F.to_json(hours.osm_hours(c, compat)),
            f"CASE k % 8 WHEN 0 THEN {week_sql((_ALL[:5], _SHOWN), (_ALL[5:], chr(39) + '8:00 AM – 11:00 PM' + chr(39)))} WHEN 1 THEN {week_sql((_ALL, chr(39) + 'Open 24 hours' + chr(39)))} WHEN 2 THEN {week_sql((['mon'], chr(39) + 'Closed' + chr(39)), (['wed'], _SHOWN))} "
            f"WHEN 3 THEN {week_sql((_ALL, chr(39) + 'Closed' + chr(39) if compat else _SHOWN))} WHEN 5 THEN {week_sql((['mon'], chr(39) + 'Closed' + chr(39)), (['sat', 'sun'], _SHOWN + ' || ' + chr(39) + ', 11:00 PM – 11:30 PM' + chr(39)))} WHEN 7 THEN {week_sql((_ALL, _SHOWN))} ELSE '{{}}' END",
        )
        for name, compat in (("week", False), ("compat", True))
    },
)
scalar(
    "H12_schema_hours",
    f"CASE {K} % 5 WHEN 0 THEN concat('{{\"openingHoursSpecification\": [{{\"dayOfWeek\": [\"http://schema.org/Monday\", \"Tuesday\", \"x\"], \"opens\": \"', {_H}, ':', {_TWO}, '\", \"closes\": \"22:30\"}}, {{\"dayOfWeek\": \"Sunday\"}}, {{\"dayOfWeek\": \"Mo\", \"opens\": \"\"}}]}}') "
    f"WHEN 1 THEN concat('{{\"openingHours\": [\"Fr-Su ', {_H}, ':', {_TWO}, '-22:30\", \"Mo 09:00-12:00\"]}}') WHEN 2 THEN concat('broken {{', {_H}) WHEN 3 THEN concat('{{\"openingHoursSpecification\": {{\"dayOfWeek\": \"Wednesday\", \"opens\": \"', {_H}, ':', {_TWO}, '\", \"closes\": \"22:30\"}}}}') "
    f"ELSE concat('{{\"name\": \"', {_H}, '\", \"openingHoursSpecification\": [{{\"dayOfWeek\": \"?\"}}], \"openingHours\": \"sat-xx ', {_H}, ':', {_TWO}, '-22:30\"}}') END",
    {
        "week": (
            lambda c: F.to_json(hours.schema_hours(c)),
            f"CASE k % 5 WHEN 0 THEN {week_sql((['mon'], chr(39) + 'Closed' + chr(39)), (['tue'], _SHOWN), (['sun'], chr(39) + 'Closed' + chr(39)))} WHEN 1 THEN {week_sql((['fri', 'sat', 'sun'], _SHOWN), (['mon'], chr(39) + '9:00 AM – 12:00 PM' + chr(39)))} "
            f"WHEN 2 THEN '{{}}' WHEN 3 THEN {week_sql((['wed'], _SHOWN))} ELSE {week_sql((['sat'], _SHOWN))} END",
        )
    },
)

# Arrays, maps, JSON ----------------------------------------------------------------------------------------------
_LIST = f"concat(CAST({K} % 3 AS STRING), ',', CAST({K} % 5 AS STRING), ',', CAST({K} % 2 AS STRING))"
scalar(
    "R01_union_distinct",
    _LIST,
    {"joined": (lambda c: F.array_join(values.union_distinct(F.array(F.lit("1"), F.lit("9")), F.split(c, ",")), ","), "array_to_string(list_transform(list_filter(list_zip(list_concat(['1', '9'], string_split(raw, ',')), range(5)), lambda x: list_position(list_concat(['1', '9'], string_split(raw, ',')), x[1]) = x[2] + 1), lambda x: x[1]), ',')")},
)
scalar(
    "R02_update_map",
    f"CASE {K} % 3 WHEN 0 THEN '' WHEN 1 THEN c_name ELSE NULL END",
    {"merged": (lambda c: F.to_json(values.update_map(F.create_map(F.lit("a"), F.lit("old"), F.lit("b"), F.lit("kept")), F.create_map(F.lit("a"), c))), "'{\"a\":\"' || coalesce(nullif(raw, ''), 'old') || '\",\"b\":\"kept\"}'")},
)
scalar("R03_first_where", _LIST, {"first_big": (lambda c: values.first_where(F.split(c, ","), lambda x: x.cast("int") >= 2), "list_filter(string_split(raw, ','), lambda x: x::INT >= 2)[1]")})
scalar("R04_entries", _LIST, {"socials": (lambda c: F.to_json(F.map_from_entries(F.array(F.struct(F.lit("FACEBOOK"), F.split(c, ",")[0])))), "'{\"FACEBOOK\":\"' || (k % 3) || '\"}'")})
scalar(
    "R05_json_column",
    f"CASE {K} % 4 WHEN 0 THEN concat('[\"', c_name, '\"', repeat(',\"b\"', CAST({K} % 9 AS INT)), ']') WHEN 1 THEN concat('broken ', c_name) WHEN 2 THEN '[]' ELSE NULL END",
    {"n": (lambda c: F.size(values.from_json_or(c, "array<string>", "[]")), "CASE WHEN raw LIKE '[\"%' THEN len(string_split(raw, ',')) ELSE 0 END"), "first": (lambda c: F.try_element_at(values.from_json_or(c, "array<string>", "[]"), F.lit(1)), "nullif(regexp_extract(raw, '^\\[\"([^\"]*)', 1), '')")},
)
scalar("R06_sorted_join", _LIST, {"joined": (lambda c: values.joined_sorted(F.split(c, ",")), "array_to_string(list_sort(list_distinct(string_split(raw, ','))), '+')")})
scalar("R07_any", _LIST, {"has_zero": (lambda c: F.exists(F.split(c, ","), lambda x: x == "0"), "list_contains(string_split(raw, ','), '0')")})
scalar("M17_first_usable", f"concat(CASE {K} % 2 WHEN 0 THEN 'N/A' ELSE ' a ' END, ',', CAST({K} AS STRING))", {"first": (lambda c: values.first_usable(F.split(c, ",")), "CASE WHEN k % 2 = 0 THEN k::VARCHAR ELSE 'a' END")})
