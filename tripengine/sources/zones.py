"""Zone shapes: vertices from geometry text, centroids, attribute tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 10_000  # vertices of a ring that are walked in one window


def polygon_centroids(
    vertices: DataFrame, key: str = "LocationID", ring: str = "ring", seq: str = "seq",
    x: str = "x", y: str = "y", hole: str = "hole", chunk: int = CHUNK,
) -> DataFrame:
    """Planar centroid per key from the vertices of its rings.

    ``hole`` tells rings that are cut out from those that bound an area (a
    table without it has no holes). Rings count with their absolute area, so
    the way they are wound does not matter. Neighbouring vertices are paired
    within chunks of a ring, then the ends of the chunks are paired, and the
    last one with the first. So a ring of any length is spread over many
    tasks. A key without area has no centroid.
    """
    if hole not in vertices.columns:
        vertices = vertices.withColumn(hole, F.lit(False))
    point = F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    walk = Window.partitionBy(key, ring, "part").orderBy(seq)
    edges = vertices.select(
        key, ring, hole, seq, F.floor(F.col(seq) / chunk).alias("part"), point.alias("here")
    ).withColumn("next", F.lead("here").over(walk))

    def sums(df: DataFrame) -> DataFrame:
        cross = F.col("here.x") * F.col("next.y") - F.col("next.x") * F.col("here.y")
        return df.groupBy(key, ring, hole).agg(
            F.sum(cross).alias("area2"),
            F.sum((F.col("here.x") + F.col("next.x")) * cross).alias("mx"),
            F.sum((F.col("here.y") + F.col("next.y")) * cross).alias("my"),
        )

    ends = edges.groupBy(key, ring, hole, "part").agg(
        F.min_by("here", seq).alias("first"), F.max_by("here", seq).alias("here")
    )
    parts = Window.partitionBy(key, ring).orderBy("part")
    whole = Window.partitionBy(key, ring).orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    links = ends.withColumn(
        "next",
        F.coalesce(F.lead("first").over(parts), F.first("first").over(whole)),
    )
    per_ring = (
        sums(edges.filter(F.col("next").isNotNull())).unionByName(sums(links))
        .groupBy(key, ring, hole)
        .agg(*[F.sum(c).alias(c) for c in ("area2", "mx", "my")])
    )
    # the sign that makes the ring's own area positive, or negative for a hole
    sign = F.signum("area2") * F.when(F.col(hole), -1).otherwise(1)
    area3 = F.sum(F.col("area2") * sign) * 3
    return per_ring.groupBy(key).agg(
        F.try_divide(F.sum(F.col("my") * sign), area3).alias("latitude"),
        F.try_divide(F.sum(F.col("mx") * sign), area3).alias("longitude"),
    )


def zone_attributes(zones: DataFrame) -> DataFrame:
    """Zone name, id and centroid, without the geometry."""
    return zones.drop("geometry").select("zone", "LocationID", "latitude", "longitude")


def ring_vertices(zones: DataFrame, key: str = "LocationID", geometry: str = "geometry") -> DataFrame:
    """Vertex rows out of polygon text (WKT): ring number, whether it is a hole, place.

    The first ring of a polygon bounds it, the others are holes. A ring that
    follows another within a polygon is parted from it by one comma and no
    bracket of the polygon.
    """
    # a ring together with what stands before its bracket: "," within a polygon,
    # "(" at a polygon's start
    pattern = r"([(,])\s*\(([^()]+)\)"
    marks = F.regexp_extract_all(geometry, F.lit(pattern), 1)
    texts = F.regexp_extract_all(geometry, F.lit(pattern), 2)
    points = F.split(F.col("one.texts"), r"\s*,\s*")
    pair = F.split(F.trim("point"), r"\s+")
    return (
        zones.select(key, F.posexplode(F.arrays_zip(marks.alias("marks"), texts.alias("texts")))
                     .alias("ring", "one"))
        .select(key, "ring", (F.col("one.marks") == ",").alias("hole"),
                F.posexplode(points).alias("seq", "point"))
        .select(
            key, "ring", "hole", "seq",
            F.get(pair, F.lit(0)).cast("double").alias("x"),
            F.get(pair, F.lit(1)).cast("double").alias("y"),
        )
    )
