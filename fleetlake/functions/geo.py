"""Great-circle distance and point-in-fence tests as column expressions."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0

#: Up to this many fences are folded into one compiled expression.
FOLD_LIMIT = 64

#: Most fence-cell rows (about 60 bytes each) that are broadcast.
BROADCAST_CELLS = 200_000


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two positions in degrees."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(half_dphi), F.lit(2.0)) + F.cos(phi1) * F.cos(phi2) * F.pow(
        F.sin(half_dlambda), F.lit(2.0)
    )
    return F.atan2(F.sqrt(chord), F.sqrt(1 - chord)) * (2 * EARTH_RADIUS_KM)


def _inside(lat: Column, lon: Column, fence_lat, fence_lon, radius) -> Column:
    # The latitude band is a cheap necessary condition that skips the trigonometry;
    # it is widened a little so that rounding can never exclude a real match.
    band = F.degrees(radius / F.lit(EARTH_RADIUS_KM)) + F.lit(1e-6)
    return (F.abs(lat - fence_lat) <= band) & (
        haversine(lat, lon, fence_lat, fence_lon) <= radius
    )


def _usable(fences: Iterable[Mapping]) -> list[Mapping]:
    """The fences that can match; one with its middle off the sphere is an error."""
    fences = list(fences)
    for f in fences:
        if abs(f["latitude"]) > 90:
            raise ValueError(f"fence {f['id']} is off the sphere: latitude {f['latitude']}")
    return [f for f in fences if f["radius"] >= 0]


def _id_type(fences: Iterable[Mapping]) -> str:
    """Whole numbers stay numbers; with any other id, all are text."""
    whole = all(isinstance(f["id"], int) and not isinstance(f["id"], bool) for f in fences)
    return "long" if whole else "string"


def first_fence(lat: Column, lon: Column, fences: Iterable[Mapping]) -> Column:
    """Id of the first fence (in list order) around the position, 0 if none."""
    fences = list(fences)
    kind = _id_type(fences)
    hits = [
        F.when(
            _inside(lat, lon, *(F.lit(float(f[k])) for k in ("latitude", "longitude", "radius"))),
            F.lit(f["id"]).cast(kind),
        )
        for f in fences
    ]
    return F.coalesce(*hits, F.lit(0).cast(kind))


def _boxes(fences: list[Mapping]) -> list[tuple[int, Mapping, float, float]]:
    """Half the height and width in degrees of each fence's box; one around a pole is all around."""
    boxes = []
    for position, fence in enumerate(fences):
        angle = fence["radius"] / EARTH_RADIUS_KM
        dlat = math.degrees(angle) + 1e-6
        cos_lat = math.cos(math.radians(fence["latitude"]))
        polar = abs(fence["latitude"]) + dlat >= 90 or math.sin(min(angle, math.pi / 2)) >= cos_lat
        dlon = 180.0 if polar else math.degrees(math.asin(math.sin(angle) / cos_lat)) + 1e-6
        boxes.append((position, fence, dlat, dlon))
    return boxes


def _edge(dlat: float, dlon: float) -> float:
    """The cell edge of a fence's size class: a power of two in degrees, no less than its box."""
    size = 2 * max(dlat, min(dlon, 5.0))
    return min(max(2.0 ** math.ceil(math.log2(size)), 2.0**-10), 16.0)


def _cells(boxes: list[tuple[int, Mapping, float, float]], edge: float, kind: str) -> list[tuple]:
    """Fences of one size class, listed under each cell that their boxes touch."""
    ring = math.ceil(360.0 / edge)
    rows = []
    for position, fence, dlat, dlon in boxes:
        south = math.floor((fence["latitude"] - dlat + 90) / edge)
        north = math.floor((fence["latitude"] + dlat + 90) / edge)
        start = (fence["longitude"] + 180.0) % 360.0
        if dlon >= 180.0 - edge:
            columns = set(range(ring + 1))
        else:
            west, east = start - dlon, start + dlon
            columns = set()
            for shift in (-360.0, 0.0, 360.0):
                lo, hi = max(west + shift, 0.0), min(east + shift, 360.0)
                if lo <= hi:
                    columns.update(range(math.floor(lo / edge), math.floor(hi / edge) + 1))
        own = int(fence["id"]) if kind == "long" else str(fence["id"])
        place = float(fence["latitude"]), float(fence["longitude"]), float(fence["radius"])
        rows += [(row, column, position, own, *place) for row in range(south, north + 1) for column in columns]
    return rows


def with_fence(
    df: DataFrame,
    fences: Iterable[Mapping],
    lat: str = "Latitude",
    lon: str = "Longitude",
    output: str = "GeofenceId",
) -> DataFrame:
    """Add the first matching fence id; rows without a position get 0.

    Short fence lists become one compiled expression, without a join. Longer lists are cut
    into cells, a grid for each size class, so that a wide fence never coarsens the cells of
    small ones: each cell lists its candidate fences once, so a lookup matches at most one
    row per position and never multiplies rows. The cells are broadcast while there are at most
    ``BROADCAST_CELLS`` of them; beyond that Spark joins by shuffle, splitting hot cells.
    """
    fences = _usable(fences)
    lat_c, lon_c = F.col(lat), F.col(lon)
    if len(fences) <= FOLD_LIMIT:
        return df.withColumn(output, first_fence(lat_c, lon_c, fences))

    kind = _id_type(fences)
    classes: dict[float, list] = {}
    for box in _boxes(fences):
        classes.setdefault(_edge(box[2], box[3]), []).append(box)
    placed, found = df, []
    for number, (edge, boxes) in enumerate(sorted(classes.items())):
        rows = _cells(boxes, edge, kind)
        hits = f"_fences{number}"
        cells = (
            df.sparkSession.createDataFrame(
                rows, f"_row long, _column long, position long, id {kind}, latitude double, longitude double, radius double"
            )
            .groupBy("_row", "_column")
            .agg(F.sort_array(F.collect_list(F.struct("position", "id", "latitude", "longitude", "radius"))).alias(hits))
        )
        if len(rows) <= BROADCAST_CELLS:
            cells = F.broadcast(cells)
        keyed = placed.withColumn("_row", F.floor((lat_c + 90) / edge).cast("long")).withColumn(
            "_column", F.floor(F.pmod(lon_c + 180, F.lit(360.0)) / edge).cast("long")
        )
        inside = F.filter(hits, lambda f: _inside(lat_c, lon_c, f["latitude"], f["longitude"], f["radius"]))
        first = F.transform(F.slice(inside, 1, 1), lambda f: F.struct(f["position"].alias("position"), f["id"].alias("id")))
        placed = keyed.join(cells, ["_row", "_column"], "left").drop("_row", "_column").withColumn(hits, first)
        found.append(F.coalesce(F.col(hits), F.array().cast(f"array<struct<position: bigint, id: {kind}>>")))
    earliest = F.get(F.sort_array(F.concat(*found)), F.lit(0))["id"]
    return placed.withColumn(output, F.coalesce(earliest, F.lit(0).cast(kind))).drop(*(f"_fences{n}" for n in range(len(found))))
