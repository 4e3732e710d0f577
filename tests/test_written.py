"""Written rows with results known by hand; the queries run the same operators over whole tables."""

import pytest
from pyspark.sql import functions as F

from waymark.functions import hours, text
from waymark.operators import pagetext, resolution
from waymark.plans.pages import _LEGACY, legacy
from waymark.sources import web

CASES = []


def listed(name, rows, columns, f, expected, out):
    CASES.append(pytest.param(rows, columns, f, expected, out, id=name))


_LD = '<script type="application/ld+json">{0}</script>'
_NODES = '{"@type": "WebPage", "a": {"@type": "Cafe", "name": "first"}, "b": [{"@type": "X"}, {"@type": ["Thing", "Restaurant"], "name": "Blue Door", "telephone": "01712345678", "priceRange": " $$ ", "aggregateRating": {"ratingValue": "4.5", "reviewCount": "1,234"}, "address": {"streetAddress": "Road 1", "addressLocality": "Dhaka"}, "geo": {"latitude": 23.5, "longitude": "90.5"}}]}'
LD_PAGES = [(1, f"<html>{_LD.replace('{0}', _NODES)}{_LD.replace('{0}', '{broken')}</html>"), (2, "<p>none</p>"), (3, _LD.replace("{0}", '[{"@type": "Bakery", "name": "B"}, {"@type": "Store", "name": "S", "aggregateRating": {"ratingValue": "7"}}]'))]
listed(
    "S17_jsonld",
    LD_PAGES,
    "id long, html string",
    lambda df: df.select("id", F.array_join(F.transform(web.jsonld(F.col("html")), lambda n: F.coalesce(F.get_json_object(n, "$.name"), F.get_json_object(n, "$['@type']"), F.lit("-"))), ",").alias("nodes")),
    [(1, "WebPage,Blue Door,-,-,-,X,first"), (2, ""), (3, "S,-,B")],
    "id, nodes",
)
listed(
    "J09_business_node",
    LD_PAGES,
    "id long, html string",
    lambda df: df.select("id", F.get_json_object(web.business_node(web.jsonld(F.col("html"))), "$.name").alias("name")),
    [(1, "Blue Door"), (2, None), (3, "S")],
    "id, name",
)
listed(
    "M23_business_payload",
    LD_PAGES,
    "id long, html string",
    lambda df: df.withColumn("p", web.business_payload(web.business_node(web.jsonld(F.col("html"))))).select("id", "p.rating", "p.review_count", "p.address", "p.phone", "p.latitude", "p.price_range"),
    [(1, 4.5, 1234, "Road 1, Dhaka", "+8801712345678", 23.5, "$$"), (2, None, None, None, None, None, None), (3, None, None, None, None, None, None)],
    "id, rating, review_count, address, phone, latitude, price_range",
)
listed(
    "M25_vendor_page",
    LD_PAGES,
    "id long, html string",
    lambda df: df.withColumn("p", web.business_payload(web.business_node(web.jsonld(F.col("html"))))).select("id", "p.rating", F.coalesce(text.status_of(F.col("html"), "moved"), F.lit("OPERATIONAL")).alias("status")),
    [(1, 4.5, "OPERATIONAL"), (2, None, "OPERATIONAL"), (3, None, "OPERATIONAL")],
    "id, rating, status",
)
listed(
    "R08_nested_nodes",
    LD_PAGES,
    "id long, html string",
    lambda df: df.select("id", F.size(web.jsonld(F.col("html"))).cast("long").alias("n")),
    [(1, 7), (2, 0), (3, 3)],
    "id, n",
)

ABOUT = [(1, "Some title\nAccessibility\nWheelchair-accessible car park\nNo-contact delivery   Delivery\nSee more\nParking lot\nDelivery\nOfferingsCoffee\nCoffee\n" + "x" * 81), (2, "no sections here"), (3, "Amenities\nWi-Fi\t\tToilets\nWi-Fi\nCrowd")]
listed(
    "T16_about_sections",
    ABOUT,
    "id long, body string",
    lambda df: pagetext.about_sections(df, "id", F.col("body")).select("id", "section", F.array_join("items", "|").alias("items")),
    [(1, "Accessibility", "Wheelchair-accessible car park|No-contact delivery|Delivery"), (1, "Parking", "lot|Delivery"), (1, "Offerings", "Coffee"), (3, "Amenities", "Wi-Fi|Toilets")],
    "id, section, items",
)


listed(
    "T18_menu_in_body",
    [(1, "Menu\nLatte ৳250\nTea - Tk. 40 and\nlatte BDT 300, Gold bar ৳ 90,000\nx ৳50"), (2, None), (3, "no price"), (4, "Mocha Tk 120 Flat White Tk 1,250.50"), (5, "৳৳৳ 5 tk. 9 bdt 77"), (6, "a" * 80 + " cake ৳15")],
    "id long, body string",
    lambda df: pagetext.body_menu(df, "id", F.col("body")),
    [(1, "Latte", 250.0), (1, "Tea", 40.0), (4, "Mocha", 120.0), (4, "Mocha Tk 120 Flat White", 1250.5), (5, "৳৳৳ 5 tk. 9", 77.0), (6, "a" * 39 + " cake", 15.0)],
    "id, item, price_bdt",
)


LEGACY = [
    ("P1", "4.4", None, None, ["N/A", "01712345678"], "Road 5, Gulshan", None, "https://x.example.com/a/?utm=1#f", {"mon": "9 AM–10 PM", "tue": "Closed"}, [(" Good\n coffee ", None, None, "5", None, "01/24", None)], "operational", "N/A"),
    ("P2", None, "1.2K", "02 8834567", None, None, "House 7", None, {d: "9 AM–10 PM" for d in ("sat", "sun", "mon", "tue", "wed")}, [(None, "Old shape", "4.0", None, "today", None, None), ("", None, "1", None, None, None, None)], "weird", "https://m.example.com/menu/"),
]



listed(
    "M16_legacy_payload",
    LEGACY,
    _LEGACY,
    lambda df: legacy(df).withColumn("hours", F.size("hours").cast("long")).withColumn("reviews", F.size("reviews").cast("long")),
    [("P1", 4.4, None, False, "+8801712345678", "Road 5, Gulshan", "https://x.example.com/a", None, None, 1, "OPERATIONAL"), ("P2", None, 1200, True, "+88028834567", "House 7", None, "https://m.example.com/menu", 5, 1, None)],
    "place_code, rating, review_count, approximate, phone, address, website, menu_url, hours, reviews, business_status",
)
listed(
    "M18_legacy_reviews",
    LEGACY,
    _LEGACY,
    lambda df: df.select("place_code", F.explode(pagetext.legacy_reviews(F.col("reviews"))).alias("r")).select("place_code", F.col("r.stars").cast("long").alias("stars"), "r.text", "r.date"),
    [("P1", 5, "Good coffee", "01/24"), ("P2", 4, "Old shape", "today")],
    "place_code, stars, text, date",
)
listed(
    "H08_legacy_hours",
    LEGACY,
    _LEGACY,
    lambda df: df.select("place_code", F.to_json(hours.normalized_hours(F.col("opening_hours"))["schedule"]).alias("week")),
    [("P1", '{"Mon":"09:00-22:00","Tue":"closed"}'), ("P2", "{" + ",".join(f'"{d}":"09:00-22:00"' for d in ("Sat", "Sun", "Mon", "Tue", "Wed")) + "}")],
    "place_code, week",
)
listed(
    "A04_legacy_richness",
    LEGACY,
    _LEGACY,
    lambda df: legacy(df).select("place_code", resolution.richness(legacy(df)).cast("long").alias("richness")),
    [("P1", 5), ("P2", 5)],
    "place_code, richness",
)

listed(
    "H11_osm_hours",
    [(1, "Mo-Fr 07:00-22:30; Sa,Su 08:00-23:00"), (2, "24/7"), (3, "Mo off"), (4, "Mo-Su 08:00-22:00; PH off"), (5, None), (6, "Sa-Mo 09:00-12:00, 13:00-17:00; Mo closed"), (7, "sometimes")],
    "id long, rules string",
    lambda df: df.select("id", F.to_json(hours.osm_hours(F.col("rules"))).alias("week"), F.to_json(hours.osm_hours(F.col("rules"), True)).alias("compat")),
    [
        (i, fixed, compat or fixed)
        for i, fixed, compat in [
            (1, '{"mon":"7:00 AM – 10:30 PM","tue":"7:00 AM – 10:30 PM","wed":"7:00 AM – 10:30 PM","thu":"7:00 AM – 10:30 PM","fri":"7:00 AM – 10:30 PM","sat":"8:00 AM – 11:00 PM","sun":"8:00 AM – 11:00 PM"}', None),
            (2, "{" + ",".join(f'"{d}":"Open 24 hours"' for d in hours.WEEK_ISO) + "}", None),
            (3, '{"mon":"Closed"}', None),
            (4, "{" + ",".join(f'"{d}":"8:00 AM – 10:00 PM"' for d in hours.WEEK_ISO) + "}", "{" + ",".join(f'"{d}":"Closed"' for d in hours.WEEK_ISO) + "}"),
            (5, "{}", None),
            (6, '{"mon":"Closed","sat":"9:00 AM – 12:00 PM, 1:00 PM – 5:00 PM","sun":"9:00 AM – 12:00 PM, 1:00 PM – 5:00 PM"}', None),
            (7, "{}", None),
        ]
    ],
    "id, week, compat",
)
listed(
    "H12_schema_hours",
    [
        (1, '{"openingHoursSpecification": [{"dayOfWeek": ["http://schema.org/Monday", "Tuesday"], "opens": "08:00", "closes": "20:30"}, {"dayOfWeek": "Sunday"}]}'),
        (2, '{"openingHours": ["Fr-Su 10:00-22:00", "Mo 09:00-12:00"]}'),
        (3, "broken {"),
    ],
    "id long, node string",
    lambda df: df.select("id", F.to_json(hours.schema_hours(F.col("node"))).alias("week")),
    [
        (1, '{"mon":"8:00 AM – 8:30 PM","tue":"8:00 AM – 8:30 PM","sun":"Closed"}'),
        (2, '{"fri":"10:00 AM – 10:00 PM","sat":"10:00 AM – 10:00 PM","sun":"10:00 AM – 10:00 PM","mon":"9:00 AM – 12:00 PM"}'),
        (3, "{}"),
    ],
    "id, week",
)


@pytest.mark.parametrize("rows, columns, f, expected, out", CASES)
def test_written_rows(spark, rows, columns, f, expected, out):
    got = f(spark.createDataFrame(rows, columns)).select(*out.split(", ")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, expected), key=str)
