"""Sections, menus and reviews out of the visible text of a page.

Lines carry their position, so 'what stands under which heading' is a window over positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.functions.numbers import PRICE_BDT, price_bdt

# Section names of an About panel, its controls, and names that are none.
SECTIONS = (
    "Accessibility", "Service options", "Highlights", "Offerings", "Amenities", "Atmosphere", "Crowd", "Planning", "Payments",
    "Children", "Pets", "Parking", "Recycling", "Getting here", "From the business", "Health & safety", "Dining options",
    "Popular for", "Lodging options", "Health and safety",
)
CONTROLS = (
    "see more", "see less", "overview", "reviews", "about", "menu", "directions", "website", "save", "share", "send to phone",
    "nearby", "photos", "updates", "add photo", "suggest an edit", "share place", "save in your lists", "call", "claim this business",
)
JUNK = ("ফলাফল", "results", "n/a", "", "search results", "google maps")


def carried(df: DataFrame, keys: list[str], position: str, value: Column, name: str) -> DataFrame:
    """Adds ``name``: the last non-null ``value`` at or before each row of its group."""
    w = Window.partitionBy(*keys).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def lines(df: DataFrame, key: str, text: Column, pieces: str = r"\n") -> DataFrame:
    """(key, pos, line): trimmed non-empty pieces of a text."""
    return df.select(key, F.posexplode(F.split(text, pieces)).alias("pos", "line")).withColumn("line", F.trim("line")).filter("line <> ''")


def distinct_lines(df: DataFrame, key: str) -> DataFrame:
    """(key, line, pos): each line of a text once, at its first position."""
    return df.groupBy(key, "line").agg(F.min("pos").alias("pos"))


def about_sections(df: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, section, items): items under the section names of an About text, distinct in order; empty sections are left out.

    Columns packed on one line (two blanks or a tab) are apart. A line that starts with a section name and goes on is that
    section's first item, so 'Parking lot' is the item 'lot' of Parking.
    """
    parts = lines(df, key, F.regexp_replace(text, r" {2,}|\t+|\s*\n\s*", "\n"))
    low = F.lower("line")
    longest = sorted(SECTIONS, key=len, reverse=True)
    exact = F.coalesce(*[F.when(low == s.lower(), F.lit(s)) for s in SECTIONS])
    glued = F.coalesce(*[F.when(low.startswith(s.lower()), F.lit(s)) for s in longest])
    tagged = parts.withColumn("_exact", exact).withColumn("_glued", F.when(F.col("_exact").isNull(), glued))
    tagged = carried(tagged, [key], "pos", F.coalesce("_exact", "_glued"), "section")
    item = F.when(F.col("_exact").isNotNull(), None).when(F.col("_glued").isNotNull(), F.trim(F.expr("substr(line, length(_glued) + 1)"))).when(F.length("line") <= 80, F.col("line"))
    items = tagged.withColumn("item", item).filter("section is not null and item is not null").filter(~F.lower("item").isin(*CONTROLS, *JUNK))
    once = items.groupBy(key, "section", "item").agg(F.min("pos").alias("pos"))
    return once.groupBy(key, "section").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda x: x["item"]).alias("items"))


def menu_sections(df: DataFrame, keys: list[str], position: str, text: str = "text") -> DataFrame:
    """Adds ``category``: the last short line without a price above each row (a heading keeps its own)."""
    t = F.trim(F.col(text))
    heading = F.when((F.length(t) >= 2) & (F.length(t) < 40) & ~t.rlike(PRICE_BDT), t)
    return carried(df, keys, position, heading, "category")


#: Characters before a price that may name its item; a price has two or more, so no more pieces than that hold them.
BEFORE = 45


def body_menu(df: DataFrame, key: str, text: Column, most: int = 60) -> DataFrame:
    """(key, item, price_bdt): items before prices in running text, the first ``most`` of each row.

    An item is the end of the line within BEFORE characters before a price: 3 to 60 characters at 10 to 20000 each, the first of
    each name in any case. The text is cut where prices begin, so a piece knows its price, and those before it the name.
    ``key`` is unique.
    """
    mark = "\x01"
    pieces = F.split(F.regexp_replace(F.regexp_replace(text, mark, " "), f"({PRICE_BDT})".replace("(?i)", "").join(("(?i)", "")), f"{mark}$1"), mark)
    cut = df.select(key, pieces.alias("_pieces"))
    before = F.array_join(F.slice("_pieces", F.greatest(F.lit(1), F.col("_pos") - BEFORE + 1), F.least(F.lit(BEFORE), F.col("_pos"))), "")
    space = r"(?U)^\s+|\s+$"
    near = F.regexp_replace(F.right(before, F.lit(BEFORE)), space, "")
    name = F.call_function("btrim", F.substring_index(near, "\n", -1), F.lit(" -,:"))
    rows = cut.select(key, "_pieces", F.posexplode("_pieces").alias("_pos", "_piece")).filter("_pos > 0")
    rows = rows.select(key, "_pos", name.alias("item"), price_bdt(F.col("_piece")).alias("price_bdt"))
    fit = rows.filter(F.length("item").between(3, 60) & F.col("price_bdt").between(10, 20_000))
    first = fit.groupBy(key, F.lower("item").alias("_name")).agg(F.min(F.struct("_pos", "item", "price_bdt")).alias("i"))
    menu = first.groupBy(key).agg(F.slice(F.sort_array(F.collect_list("i")), 1, most).alias("menu"))
    return menu.select(key, F.explode("menu").alias("i")).select(key, "i.item", "i.price_bdt")


def reviews(df: DataFrame, key: str, least: int = 25, most: int = 5) -> DataFrame:
    """The first ``most`` reviews of each place whose text has at least ``least`` characters, each review id once (rows without
    an id all count). ``df``: key, pos, review_id, text."""
    text = F.substring(F.trim(F.regexp_replace("text", r"(?U)\s+", " ")), 1, 600)
    once = F.coalesce(F.col("review_id"), F.concat(F.lit("row "), F.col("pos").cast("string")))
    cut = df.withColumn("text", text).filter(F.length("text") >= least).withColumn("_once", once)
    first = cut.withColumn("_rn", F.row_number().over(Window.partitionBy(key, "_once").orderBy("pos"))).filter("_rn = 1")
    return first.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).filter(F.col("place") <= most).drop("_rn", "_once")


def legacy_reviews(c: Column) -> Column:
    """Reviews of any older shape as stars, text (600 characters) and date; nothing about who wrote them is kept."""
    has = lambda r, f: F.when(F.trim(r[f]) != "", r[f])
    kept = F.filter(c, lambda r: F.coalesce(has(r, "text"), has(r, "full_review_text")).isNotNull())
    return F.transform(
        kept,
        lambda r: F.struct(
            F.coalesce(has(r, "rating"), has(r, "stars")).try_cast("double").cast("int").alias("stars"),
            F.substring(F.trim(F.regexp_replace(F.coalesce(has(r, "text"), has(r, "full_review_text")), r"(?U)\s+", " ")), 1, 600).alias("text"),
            F.trim(F.coalesce(has(r, "date"), has(r, "date_mmyy"), has(r, "time_ago"))).alias("date"),
        ),
    )
