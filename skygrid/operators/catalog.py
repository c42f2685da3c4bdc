"""Searches over the granule catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.functions.lookup import DEFAULT_VERSIONS, map_lookup


def search_granules(catalog: DataFrame, file_class: str, product: str, start: str, end: str,
                    limit: int | None = None) -> DataFrame:
    """Granules starting in [start 00:00, end 23:59:59.999), newest first; ``*`` matches any class or type."""
    found = catalog.where((F.col("start_time") >= F.lit(start).cast("timestamp"))
                          & (F.col("start_time") < F.lit(f"{end} 23:59:59.999").cast("timestamp")))
    for text in (file_class, product):
        if text != "*":
            found = found.where(F.contains(F.col("name"), F.lit(text)))
    ordered = found.orderBy(F.desc("start_time"), F.asc("granule_id"))
    return ordered if limit is None else ordered.limit(limit)


def footprint_intersects(catalog: DataFrame, bounds) -> DataFrame:
    """Granules whose bounding box touches the box (lon_min, lon_max, lat_min, lat_max)."""
    lon_min, lon_max, lat_min, lat_max = (float(b) for b in bounds)
    return catalog.where((F.col("lon_min") <= lon_max) & (F.col("lon_max") >= lon_min)
                         & (F.col("lat_min") <= lat_max) & (F.col("lat_max") >= lat_min))


def _turn(a: Column, b: Column, lon, lat) -> Column:
    """Positive where the point lies left of the way from ``a`` to ``b``, zero on its line."""
    return (b["lon"] - a["lon"]) * (lat - a["lat"]) - (b["lat"] - a["lat"]) * (lon - a["lon"])


def _edges(ring: Column) -> Column:
    return F.transform(ring, lambda p, k: F.struct(p.alias("a"), F.get(ring, (k + 1) % F.size(ring)).alias("b")))


def _meet(e: Column, f: Column) -> Column:
    """Two edges share a point: their boxes do, and each has the ends of the other on both sides of its line."""
    boxes = [(F.greatest(x["a"][c], x["b"][c]) >= F.least(y["a"][c], y["b"][c])) for c in ("lon", "lat") for x, y in ((e, f), (f, e))]
    sides = [_turn(x["a"], x["b"], y["a"]["lon"], y["a"]["lat"]) * _turn(x["a"], x["b"], y["b"]["lon"], y["b"]["lat"]) <= 0
             for x, y in ((e, f), (f, e))]
    return boxes[0] & boxes[1] & boxes[2] & boxes[3] & sides[0] & sides[1]


def _inside(edges: Column, point: Column) -> Column:
    """Even-odd rule: edges that cross the ray from the point to the east."""
    def crossed(e):
        a, b, lat = e["a"]["lat"], e["b"]["lat"], point["lat"]
        turn = _turn(e["a"], e["b"], point["lon"], lat)
        return ((a <= lat) & (b > lat) & (turn > 0)) | ((b <= lat) & (a > lat) & (turn < 0))
    return F.size(F.filter(edges, crossed)) % 2 == 1


def ring_intersects(ring: Column, region: Sequence) -> Column:
    """Whether an outline shares a point with a region, borders included.

    ``ring`` is an array of structs (lon, lat), closed or not; ``region`` a box (lon_min, lon_max, lat_min, lat_max) or a list of
    (lon, lat). Either may cross the antimeridian, in longitudes beyond 180 or with a jump of sign: vertices are taken on the turn
    of the globe nearest to their ring's first one, so a ring reaches less than 180 degrees from it and holds no pole. The region is
    tried on three turns. An outline that is null or has no vertices, or a null in it, meets nothing.
    """
    if len(region) == 4 and not isinstance(region[0], (tuple, list)):
        west, east, south, north = region
        region = [(west, south), (east, south), (east, north), (west, north)]
    lon0 = float(region[0][0])
    corners = [(float(x) - 360.0 * round((float(x) - lon0) / 360.0), float(y)) for x, y in region]
    low, high = (tuple(f(c[k] for c in corners) for k in (0, 1)) for f in (min, max))
    point = lambda x, y: F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat"))

    def on_turn(edges: Column, ring: Column, turn: float) -> Column:
        moved = [point(x + turn, y) for x, y in corners]
        other = F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in zip(moved, moved[1:] + moved[:1])])
        lon, lat = F.transform(ring, lambda p: p["lon"]), F.transform(ring, lambda p: p["lat"])
        boxes = ((F.array_min(lon) <= high[0] + turn) & (F.array_max(lon) >= low[0] + turn)
                 & (F.array_min(lat) <= high[1]) & (F.array_max(lat) >= low[1]))
        crossing = F.exists(edges, lambda e: F.exists(other, lambda f: _meet(e, f)))
        return boxes & (crossing | _inside(edges, moved[0]) | _inside(other, F.get(ring, F.lit(0))))

    first = F.get(ring, F.lit(0))["lon"].cast("double")
    turns = F.floor((first - lon0) / 360.0 + 0.5).cast("double") * 360.0
    near = F.transform(ring, lambda p: F.struct(
        (p["lon"] - turns - 360.0 * F.round((p["lon"] - first) / 360.0)).cast("double").alias("lon"), p["lat"].cast("double").alias("lat")))
    # A one-element array names the ring, then its edges, so that each is worked out once a row.
    found = F.exists(F.array(near), lambda r: F.exists(F.array(_edges(r)), lambda e: (
        on_turn(e, r, 0.0) | on_turn(e, r, 360.0) | on_turn(e, r, -360.0))))
    return F.coalesce(found, F.lit(False))


def search_footprints(catalog: DataFrame, region: Sequence, ring: str = "footprint") -> DataFrame:
    """Granules whose true outline, not its box alone, meets the region; see ``ring_intersects``."""
    return catalog.where(ring_intersects(F.col(ring), region))


def overlaps_period(catalog: DataFrame, start: str, end: str) -> DataFrame:
    """Items whose own interval meets [start, end], in order of their start."""
    s, e = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return (catalog.where(~((F.col("end_time") < s) | (F.col("start_time") > e)))
            .orderBy("start_time", "granule_id"))


def latest_version(catalog: DataFrame, keys=("product", "file_class"),
                   defaults: Mapping[str, str] = DEFAULT_VERSIONS) -> DataFrame:
    """Largest version text per product, else the default one."""
    default = map_lookup(F.col("product"), defaults) if defaults else F.lit(None).cast("string")
    return catalog.groupBy(*keys).agg(F.max("ver").alias("_v")).select(
        *keys, F.coalesce("_v", default).alias("ver"))


def exclude_nrt(catalog: DataFrame, name: str = "name", link: str = "link") -> DataFrame:
    """Drop near-real-time files and entries without a link."""
    return catalog.where(~F.contains(F.col(name), F.lit(".NRT.hdf")) & F.col(link).isNotNull())


def pending_granules(catalog: DataFrame, ledger: DataFrame, key: str = "granule_id") -> DataFrame:
    """Granules neither processed nor known to be empty; failed ones are tried again."""
    done = ledger.where(F.col("status").isin("ok", "empty")).select(key)
    return catalog.join(done, key, "left_anti")


def run_summary(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count("*").alias("n"))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def frame_order(files: DataFrame, time: Column, name: str = "name") -> DataFrame:
    """Files by their own time, then by name; files without a time come last."""
    return files.withColumn("frame_time", time).orderBy(F.asc_nulls_last("frame_time"), name)
