"""Places laid out so that a box reads few files.

Rows are written in order of a Hilbert curve, so each file holds a compact area, and beside them one row a file with the
bounds of what it holds. A box is two ranges: it picks the files whose bounds meet it, and its ranges reach their scan as
pushed filters, where row groups are left out the same way.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of each coordinate on the curve: cells of about 600 m by 300 m at the equator.
BITS = 16


class Box(NamedTuple):
    south: float
    west: float
    north: float
    east: float


def hilbert(latitude: Column, longitude: Column, bits: int = BITS) -> Column:
    """Place of a point along a Hilbert curve over the whole globe; null without a point on it.

    From the largest squares to the smallest: the quadrant gives two bits, and turns the curve within it.
    """
    side = 1 << bits
    cell = lambda c, least, width: F.least(F.lit(side - 1), F.floor((c + least) / width * side)).cast("long")
    start = F.struct(cell(longitude, 180.0, 360.0).alias("x"), cell(latitude, 90.0, 180.0).alias("y"), F.lit(0).cast("long").alias("d"))

    def step(at: Column, s: Column) -> Column:
        right, up = F.when(at["x"].bitwiseAND(s) > 0, 1).otherwise(0), F.when(at["y"].bitwiseAND(s) > 0, 1).otherwise(0)
        place = at["d"] + s * s * (3 * right).bitwiseXOR(up)
        # Lower quadrants are flipped about a diagonal, the right one of them mirrored as well.
        flipped = up == 0
        mirror = lambda v: F.when(flipped & (right == 1), side - 1 - v).otherwise(v)
        x, y = mirror(at["x"]), mirror(at["y"])
        return F.struct(F.when(flipped, y).otherwise(x).alias("x"), F.when(flipped, x).otherwise(y).alias("y"), place.cast("long").alias("d"))

    squares = F.array(*[F.lit(1 << b).cast("long") for b in reversed(range(bits))])
    on_globe = latitude.between(-90, 90) & longitude.between(-180, 180)
    return F.when(on_globe, F.aggregate(squares, start, step, lambda at: at["d"]))


def write_places(df: DataFrame, path: str, files: int) -> None:
    """Write rows with latitude and longitude into about ``files`` files along the curve, and their bounds. Rows without a
    point are kept, and are in no box. A folder that is there already is an error."""
    place = hilbert(F.col("latitude"), F.col("longitude"))
    spread = F.monotonically_increasing_id()  # many rows at one point are many files, not one
    laid = df.withColumn("_place", place).withColumn("_row", spread).repartitionByRange(files, "_place", "_row").sortWithinPartitions("_place")
    laid.drop("_place", "_row").write.parquet(f"{path}/data")
    rows = df.sparkSession.read.parquet(f"{path}/data")
    bounds = [f(F.col(c)).alias(f"{f.__name__}_{c}") for c in ("latitude", "longitude") for f in (F.min, F.max)]
    rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*bounds).write.parquet(f"{path}/bounds")


def files_of(spark: SparkSession, path: str, box: Box) -> list[str]:
    """The files whose bounds meet the box: at most as many names as there are files."""
    meets = "min_latitude <= {n} and max_latitude >= {s} and min_longitude <= {e} and max_longitude >= {w}"
    found = spark.read.parquet(f"{path}/bounds").filter(meets.format(s=repr(box.south), w=repr(box.west), n=repr(box.north), e=repr(box.east)))
    return sorted(r[0] for r in found.select("file").collect())


def read_box(spark: SparkSession, path: str, box: Box | None) -> DataFrame:
    """Rows inside the box, its edges included, from the files that can hold any; without a box there are none."""
    everything = spark.read.parquet(f"{path}/data")
    files = files_of(spark, path, box) if box else []
    if not files:
        return everything.limit(0)
    rows = spark.read.schema(everything.schema).parquet(*files)
    return rows.filter(rows["latitude"].between(box.south, box.north) & rows["longitude"].between(box.west, box.east))


def box_of(bounds: DataFrame) -> Box | None:
    """The box of a one-row table (south, west, north, east), so that scans can be planned with it; None where it is empty."""
    row = bounds.select(*Box._fields).head()
    return None if row is None or None in row else Box(*row)
