"""Names, phones, URLs and page text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import PRICE_BDT, matched, number
from .values import is_empty

# Formats in map pages and contact data.
PHONE_SPAN = r"(?<![\d])(\+?\d{2,}(?:[\s\-().]{1,2}\d{2,}){0,4})(?![\d])"
PLACE_COORDS = r"!3d(-?\d+\.\d+)!4d(-?\d+\.\d+)"
VIEW_COORDS = r"@(-?\d+\.\d+),(-?\d+\.\d+)"
PLACE_ID = r"!1s(0x[0-9a-fA-F]+:0x[0-9a-fA-F]+)"
FACEBOOK = r"https?://(?:www\.|m\.|web\.)?facebook\.com/(?!sharer|share|tr[/?]|dialog|plugins|events/)[\w.\-]+/?"
INSTAGRAM = r"https?://(?:www\.)?instagram\.com/(?!p/|reel/|explore/|accounts/)[\w.\-]+/?"
PRICE_SPAN = r"[৳Tk]?\s*[\d,]+\s*[–—-]\s*[৳Tk]?\s*[\d,]+(?:\s*per person)?"
JUNK_NAMES = ("ফলাফল", "results", "n/a", "", "search results", "google maps")


def name_tokens(c: Column) -> Column:
    """Distinct lower-case runs of a-z and 0-9 longer than two."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+"), lambda t: F.length(t) > 2))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays; 0.0 if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def name_match(a: Column, b: Column) -> Column:
    return jaccard(name_tokens(a), name_tokens(b))


def norm_bd_phone(c: Column) -> Column:
    """+880 and the national number of a Bangladeshi mobile or Dhaka landline, else NULL."""
    d = F.regexp_replace(F.regexp_replace(c, r"(?U)[^\d+]", ""), r"^\++", "")
    d = F.regexp_replace(F.regexp_replace(d, "^(00880|880)", ""), "^0+", "")
    return F.when(d.rlike(r"^(1[3-9]\d{8}|2\d{7,8})$"), F.concat(F.lit("+880"), d))


def find_phones(c: Column) -> Column:
    """Distinct normalised phones in order of their first place in the text."""
    spans = F.regexp_extract_all(c, F.lit(PHONE_SPAN), F.lit(1))
    return F.array_distinct(F.filter(F.transform(spans, norm_bd_phone), lambda p: p.isNotNull()))


def clean_url(c: Column, keep_bare_query: bool = False) -> Column:
    """http(s) URL without fragment, query and trailing slashes; NULL for anything else. ``keep_bare_query`` leaves a
    '?' with nothing behind it (and the slashes before it) alone."""
    bare = F.substring_index(c, "#", 1)
    host = matched(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?]+)")
    url = F.substring_index(bare, "?", 1)
    if keep_bare_query:
        url = F.when(bare.rlike(r"^[^?]*\?$"), bare).otherwise(url)
    return F.when(~is_empty(c) & c.startswith("http") & host.isNotNull(), F.regexp_replace(url, "/+$", ""))


def slugify(c: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(s == "", "unknown").otherwise(F.coalesce(s, F.lit("unknown")))


def file_slug(c: Column, length: int = 40) -> Column:
    return F.substring(F.regexp_replace(c, r"(?U)[^\p{Alnum}]", "_"), 1, length)


def collapsed(c: Column, length: int | None = None) -> Column:
    """White space runs as one blank, trimmed, cut to ``length``."""
    t = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    return t if length is None else F.substring(t, 1, length)


def clean_price_level(c: Column) -> Column:
    """The 'a - b per person' span of a label, else the trimmed label."""
    return F.trim(F.coalesce(matched(c, PRICE_SPAN, 0), c, F.lit("")))


def without_label(c: Column, *labels: str) -> Column:
    for label in labels:
        c = F.replace(c, F.lit(label), F.lit(""))
    return collapsed(c)


def facebook_url(c: Column) -> Column:
    return clean_url(matched(c, FACEBOOK, 0))


def instagram_url(c: Column) -> Column:
    return clean_url(matched(c, INSTAGRAM, 0))


def url_coords(c: Column) -> Column:
    """struct(latitude, longitude): the place's, else the two parts given apart, else the view's."""

    def pair(a: Column, b: Column) -> Column:
        return F.when(a.isNotNull() & b.isNotNull(), F.struct(a.try_cast("double").alias("latitude"), b.try_cast("double").alias("longitude")))

    return F.coalesce(
        pair(matched(c, PLACE_COORDS, 1), matched(c, PLACE_COORDS, 2)),
        pair(matched(c, r"!3d(-?\d+\.\d+)"), matched(c, r"!4d(-?\d+\.\d+)")),
        pair(matched(c, VIEW_COORDS, 1), matched(c, VIEW_COORDS, 2)),
    )


def place_id(c: Column) -> Column:
    return matched(c, PLACE_ID)


def search_url(name: Column, area: Column, lat: Column, lng: Column) -> Column:
    query = F.concat(name, F.lit(", "), F.coalesce(area, F.lit("Dhaka")), F.lit(", Dhaka, Bangladesh"))
    return F.concat(F.lit("https://www.google.com/maps/search/"), F.url_encode(query), F.lit("/@"), lat.cast("string"), F.lit(","), lng.cast("string"), F.lit(",17z?hl=en"))


def status_of(c: Column, variant: str = "package") -> Column:
    """Business status named in a text, NULL if none is. Variants: package, moved (adds 'temporarily unavailable' and moved venues), tag."""
    low = F.lower(F.coalesce(c, F.lit("")))
    has = lambda *words: F.greatest(*[low.contains(w) for w in words], F.lit(False))
    if variant == "tag":
        return F.when(has("permanently closed"), "Permanently Closed").when(has("temporarily closed"), "Temporarily Closed")
    out = F.when(has("permanently closed", "closed permanently"), "PERMANENTLY_CLOSED")
    if variant == "moved":
        return out.when(has("temporarily closed", "temporarily unavailable"), "TEMPORARILY_CLOSED").when(has("has moved", "moved to a new location"), "MOVED")
    return out.when(has("temporarily closed"), "TEMPORARILY_CLOSED")


def detected_status(badge: Column, head: Column) -> Column:
    """The badge's status, else the page head's, else operational."""
    return F.coalesce(status_of(badge), status_of(head), F.lit("OPERATIONAL"))


def stars(c: Column) -> Column:
    return matched(c, "([1-5])").try_cast("long")


def menu_item(c: Column) -> Column:
    """struct(item, price_bdt) of a menu card's text; NULL if what is left beside the price is no name of 3 to 79 characters."""
    text = collapsed(c)
    name = _strip(F.substring(collapsed(F.regexp_replace(text, PRICE_BDT, "")), 1, 80), " -,")
    return F.when((F.length(name) > 2) & (F.length(name) < 80), F.struct(name.alias("item"), price(text).alias("price_bdt")))


def price(c: Column) -> Column:
    return number(matched(c, PRICE_BDT))


def _strip(c: Column, characters: str) -> Column:
    return F.call_function("btrim", c, F.lit(characters))


def brand_phone(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)[^\d\s+\-()]+", ""))


def brand_address(c: Column) -> Column:
    return collapsed(F.replace(c, F.lit("\n"), F.lit(", ")))


def place_name(headings: Column) -> Column:
    """First heading that is no junk, else 'N/A'."""
    trimmed = F.transform(headings, lambda h: F.trim(h))
    return F.coalesce(F.try_element_at(F.filter(trimmed, lambda h: ~F.lower(h).isin(*JUNK_NAMES)), F.lit(1)), F.lit("N/A"))


def is_brand(name: Column, brand: str, aliases: tuple[str, ...], keywords: tuple[str, ...]) -> Column:
    """Not junk, and an alias as written or the brand with a keyword in any case."""
    low = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    any_of = lambda c, words: F.greatest(*[c.contains(w) for w in words], F.lit(False))
    return F.coalesce(~low.isin(*JUNK_NAMES) & (any_of(name, aliases) | (low.contains(brand.lower()) & any_of(low, keywords))), F.lit(False))


def fallback_text(*candidates: Column, least: int = 1) -> Column:
    """The first candidate whose trimmed text has at least ``least`` characters."""
    return F.coalesce(*[F.when(F.length(F.trim(c)) >= least, F.trim(c)) for c in candidates])
