"""Swath to grid. A regridder is a function ``(pixels, grid, ...) -> cells``.

``pixels`` has ``granule_id, pixel_id, row_idx, col_idx, lat, lon, value`` (and
``qa`` where weights are used); the result has ``granule_id, i, j, value, count``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrid.functions.geo import is_finite
from skygrid.operators.qc import drop_zero_fill
from skygrid.plans.grid import GridSpec
from skygrid.plans.dimension import fact_table
from skygrid.plans.neighbours import candidate_cells, gather, offsets_array, one_per_place, outward_nearest, window_cells

CELL = ("granule_id", "i", "j")


def valid_pixels(pixels: DataFrame) -> DataFrame:
    return pixels.where(is_finite(F.col("value")) & is_finite(F.col("lat"))
                        & is_finite(F.col("lon")))


# -- footprints -------------------------------------------------------------------

def swath_extent(pixels: DataFrame) -> DataFrame:
    """Rows and columns of each granule, one line per granule."""
    return pixels.groupBy("granule_id").agg((F.max("row_idx") + 1).alias("n_rows"),
                                            (F.max("col_idx") + 1).alias("n_cols"))


# Weight of a centre in the corners of an axis, by the distance from the centre to the
# place that asks. Inside, a corner is the mean of its two neighbours; at both ends it is
# the linear continuation of the two corners before it.
# corner index - centre index: (inside, first corner, last corner)
CORNER_WEIGHTS = {-2: (0.0, -0.5, 0.0), -1: (0.0, 0.5, 0.0), 0: (0.5, 1.0, 0.0),
                  1: (0.5, 0.0, 1.0), 2: (0.0, 0.0, 0.5), 3: (0.0, 0.0, -0.5)}
# pixel index - centre index: lower corner (inside, first pixel), upper corner (inside, last pixel)
PIXEL_WEIGHTS = {-2: (0.0, -0.5, 0.0, 0.0), -1: (0.0, 0.5, 0.5, 0.5), 0: (0.5, 1.0, 0.5, 1.0),
                 1: (0.5, 0.5, 0.0, 0.5), 2: (0.0, 0.0, 0.0, -0.5)}


def with_extent(pixels: DataFrame) -> DataFrame:
    """Pixels with the shape of their granule. Readers that know the shape store
    ``n_rows`` and ``n_cols``; only tables without them pay for a join."""
    if {"n_rows", "n_cols"} <= set(pixels.columns):
        return pixels
    return pixels.join(fact_table(swath_extent(pixels), "extents"), "granule_id")


def _weighted_offsets(weights: dict[int, tuple]) -> Column:
    """All pairs of a row and a column offset with their weights, as one literal array."""
    def entry(d: int, name: str) -> list[Column]:
        return [F.lit(d).alias(f"d{name}"), *[F.lit(w).alias(f"{name}{k}") for k, w in enumerate(weights[d])]]
    return F.array(*[F.struct(*entry(a, "r"), *entry(b, "c")) for a in weights for b in weights])


def corners_from_centers(pixels: DataFrame) -> DataFrame:
    """The (n+1) x (m+1) pixel corners of every granule: ``k, l, lat, lon``.

    The rule is separable, so each pixel adds its weighted position to the corners
    it touches and one hash aggregation adds them up; needs 3 rows and 3 columns.
    """
    places = one_per_place(with_extent(pixels), ["granule_id"], "row_idx", "col_idx", ["n_rows", "n_cols", "lat", "lon"])

    def weight(k: str, n: str, name: str) -> Column:
        return (F.when(F.col(k) == 0, F.col(f"_o.{name}1")).when(F.col(k) == F.col(n), F.col(f"_o.{name}2"))
                .otherwise(F.col(f"_o.{name}0")))

    def sources(k: str, n: str) -> Column:
        return F.when((F.col(k) == 0) | (F.col(k) == F.col(n)), 3).otherwise(2)

    sent = (places.withColumn("_o", F.explode(_weighted_offsets(CORNER_WEIGHTS)))
            .withColumns({"k": F.col("row_idx") + F.col("_o.dr"), "l": F.col("col_idx") + F.col("_o.dc")})
            .where(F.col("k").between(0, F.col("n_rows")) & F.col("l").between(0, F.col("n_cols")))
            .withColumn("w", weight("k", "n_rows", "r") * weight("l", "n_cols", "c")))
    summed = sent.where(F.col("w") != 0).groupBy("granule_id", "n_rows", "n_cols", "k", "l").agg(
        F.count(F.col("lat") + F.col("lon")).alias("n"),
        F.sum(F.col("w") * F.col("lat")).alias("lat"), F.sum(F.col("w") * F.col("lon")).alias("lon"))
    complete = F.col("n") == sources("k", "n_rows") * sources("l", "n_cols")
    return summed.select("granule_id", "k", "l", F.when(complete, F.col("lat")).alias("lat"),
                         F.when(complete, F.col("lon")).alias("lon"))


CORNER_COLUMNS = tuple(f"{n}_{x}" for n in "abcd" for x in ("lat", "lon"))


def near_wanted(pixels: DataFrame, wanted: Column, side: int = 32) -> DataFrame:
    """Pixels in the blocks of ``side`` x ``side`` positions that hold a wanted pixel, and in the blocks around those.

    The probe reads narrow columns under pushed-down filters; its blocks, one row each, are counted before they
    meet the pixels. Neighbours within a block's width are all there, so corners of wanted pixels do not change.
    """
    block = {"_br": F.expr(f"row_idx div {side}"), "_bc": F.expr(f"col_idx div {side}")}
    around = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    blocks = (pixels.where(wanted).withColumns(block).select("granule_id", "_br", "_bc").distinct()
              .withColumn("_o", F.explode(offsets_array(around)))
              .select("granule_id", (F.col("_br") + F.col("_o.dr")).alias("_br"), (F.col("_bc") + F.col("_o.dc")).alias("_bc")).distinct())
    return pixels.withColumns(block).join(fact_table(blocks, "blocks"), ["granule_id", "_br", "_bc"], "left_semi").drop("_br", "_bc")


def pixel_footprints(pixels: DataFrame, carry=("value", "qa")) -> DataFrame:
    """Each pixel with its four corners ``a..d`` (a = upper row and left column, then around).

    A pixel is sent to the nine neighbours whose corners use it. Of rows that claim one
    place the smallest pixel_id counts, so a repeated row changes nothing.
    Pixels with an incomplete neighbourhood have no footprint and are left out.
    """
    places = one_per_place(with_extent(pixels), ["granule_id"], "row_idx", "col_idx", ["n_rows", "n_cols", "lat", "lon", *carry])
    row, col, dr, dc = F.col("_r"), F.col("_c"), F.col("_o.dr"), F.col("_o.dc")
    last_row, last_col = F.col("n_rows") - 1, F.col("n_cols") - 1

    def used(place: Column, d: Column, last: Column) -> Column:
        """Direct neighbours, and two steps away from the first and the last place."""
        return place.between(0, last) & ((F.abs(d) <= 1) | (place == F.when(d < 0, 0).otherwise(last)))

    sent = (places.withColumn("_o", F.explode(_weighted_offsets(PIXEL_WEIGHTS)))
            .withColumns({"_r": F.col("row_idx") + dr, "_c": F.col("col_idx") + dc})
            .where(used(row, dr, last_row) & used(col, dc, last_col))
            .withColumns({
                "_up": F.when(row == 0, F.col("_o.r1")).otherwise(F.col("_o.r0")),
                "_dn": F.when(row == last_row, F.col("_o.r3")).otherwise(F.col("_o.r2")),
                "_lf": F.when(col == 0, F.col("_o.c1")).otherwise(F.col("_o.c0")),
                "_rt": F.when(col == last_col, F.col("_o.c3")).otherwise(F.col("_o.c2")),
                "_own": (dr == 0) & (dc == 0)}))
    corners = {"a": ("_up", "_lf"), "b": ("_dn", "_lf"), "c": ("_dn", "_rt"), "d": ("_up", "_rt")}
    sums = [F.sum(F.col(v) * F.col(h) * F.col(x)).alias(f"{name}_{x}")
            for name, (v, h) in corners.items() for x in ("lat", "lon")]
    kept = [F.max(F.when(F.col("_own"), F.col(c))).alias(c) for c in ("pixel_id", "lat", "lon", *carry)]
    return (sent.groupBy("granule_id", F.col("_r").alias("row_idx"), F.col("_c").alias("col_idx"))
            .agg(*kept, F.count(F.col("lat") + F.col("lon")).alias("_n"), *sums)
            .where((F.col("_n") == 9) & F.col("pixel_id").isNotNull()).drop("_n"))


def supersample_regrid(pixels: DataFrame, grid: GridSpec, k: int = 4, qa_threshold: float = 0.5) -> DataFrame:
    """Area-weighted gridding: k x k points spread over each footprint, weight qa / k^2 each.

    ``value`` is the weighted mean of the points in a cell, ``count`` their number. Footprints are derived from
    neighbouring centres, or taken from columns ``a_lat`` .. ``d_lon`` where the granule has them.
    """
    if "qa" not in pixels.columns:
        pixels = pixels.withColumn("qa", F.lit(1.0))
    wanted = ((F.col("qa") >= qa_threshold) & is_finite(F.col("value"))
              & grid.contains(F.col("lat"), F.col("lon")))
    # Corners that come with the pixels need no neighbours; else only blocks near the grid are exchanged.
    if set(CORNER_COLUMNS) <= set(pixels.columns):
        feet = pixels.where(wanted)
    else:
        feet = pixel_footprints(near_wanted(with_extent(pixels), wanted)).where(wanted)
    # Bilinear blend of the corners as a polynomial in (s, t); its coefficients are per pixel.
    terms = {f"_{x}{n}": e for x in ("lat", "lon") for n, e in enumerate((
        F.col(f"a_{x}"), F.col(f"b_{x}") - F.col(f"a_{x}"), F.col(f"d_{x}") - F.col(f"a_{x}"),
        F.col(f"a_{x}") - F.col(f"b_{x}") + F.col(f"c_{x}") - F.col(f"d_{x}")))}
    steps = [(n + 0.5) / k for n in range(k)]
    points = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(t).alias("t"), F.lit(s * t).alias("st"))
                       for s in steps for t in steps])

    def blend(x: str) -> Column:
        return (F.col(f"_{x}0") + F.col("_p.s") * F.col(f"_{x}1") + F.col("_p.t") * F.col(f"_{x}2")
                + F.col("_p.st") * F.col(f"_{x}3"))

    spread = (feet.select("granule_id", (F.col("qa") / (k * k)).alias("w"), "value", *[e.alias(n) for n, e in terms.items()])
              .withColumn("_p", F.explode(points))
              .select("granule_id", "w", "value", blend("lat").alias("_y"), blend("lon").alias("_x")))
    binned = grid.with_cell(spread, "_y", "_x")
    return binned.groupBy(*CELL).agg(
        F.try_divide(F.sum(F.col("w") * F.col("value")), F.sum("w")).alias("value"),
        F.count("*").cast("double").alias("count"))


# -- point methods ----------------------------------------------------------------

def _one(cells: DataFrame) -> DataFrame:
    return cells.withColumn("count", F.lit(1.0))


def nearest_regrid(pixels: DataFrame, grid: GridSpec, max_distance=0.1, most: float | None = None) -> DataFrame:
    """Nearest valid pixel within ``max_distance``; the lower pixel_id wins a tie. ``most`` bounds a distance given as a column."""
    return _one(outward_nearest(valid_pixels(pixels), grid, ["granule_id"], "pixel_id", ["value"], max_distance, most).drop("d"))


def nearest_limited(pixels: DataFrame, grid: GridSpec, max_distance: float = 0.25) -> DataFrame:
    return nearest_regrid(pixels, grid, max_distance)


def idw_regrid(pixels: DataFrame, grid: GridSpec, max_distance: float = 0.2) -> DataFrame:
    """Mean of the pixels within ``max_distance``, weighted 1 / (d + 1e-6)."""
    pairs = candidate_cells(valid_pixels(pixels), grid, max_distance).withColumn("w", 1 / (F.col("d") + 1e-6))
    return _one(pairs.groupBy(*CELL).agg((F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("value")))


def smooth_regrid(pixels: DataFrame, grid: GridSpec, max_distance=0.1, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel mean over the pixels within ``max_distance``: the viewing mode.

    Uses every pixel and no linear solve. ``bandwidth`` defaults to half the distance.
    """
    radius = max_distance if isinstance(max_distance, Column) else F.lit(float(max_distance))
    width = F.lit(float(bandwidth)) if bandwidth else radius / 2
    pairs = candidate_cells(valid_pixels(pixels), grid, radius)
    pairs = pairs.withColumn("w", F.exp(-(F.col("d") * F.col("d")) / (2 * width * width)))
    return _one(pairs.groupBy(*CELL).agg((F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("value")))


def linear_regrid(pixels: DataFrame, grid: GridSpec, max_distance: float = 0.15,
                  drop_negative: bool = True) -> DataFrame:
    """Linear interpolation on the swath's own mesh, kept within ``max_distance`` of a pixel.

    Four neighbouring pixels make two triangles, three valid ones make one. Each
    triangle emits the cells of its box with their barycentric weights.
    """
    ok = valid_pixels(pixels)
    quad = gather(ok, ["granule_id"], "row_idx", "col_idx",
                  {"a": (0, 0), "b": (1, 0), "c": (1, 1), "d": (0, 1)}, ["lat", "lon", "value"])

    def tri(*names: str) -> Column:
        fields = [F.col(f"{n}_{x}").alias(f"{x}{k}") for k, n in enumerate(names) for x in ("lat", "lon", "value")]
        return F.struct(*fields)

    has = {n: F.col(f"{n}_lat").isNotNull() for n in "abcd"}
    triangles = (F.when(has["a"] & has["c"] & has["b"] & has["d"], F.array(tri("a", "b", "c"), tri("a", "c", "d")))
                 .when(has["a"] & has["b"] & has["c"], F.array(tri("a", "b", "c")))
                 .when(has["a"] & has["c"] & has["d"], F.array(tri("a", "c", "d")))
                 .when(has["a"] & has["b"] & has["d"], F.array(tri("a", "b", "d")))
                 .when(has["b"] & has["c"] & has["d"], F.array(tri("b", "c", "d"))))
    faces = quad.select("granule_id", F.explode(triangles).alias("_t")).select("granule_id", "_t.*")
    cells = window_cells(faces, grid, F.least("lat0", "lat1", "lat2"), F.greatest("lat0", "lat1", "lat2"),
                         F.least("lon0", "lon1", "lon2"), F.greatest("lon0", "lon1", "lon2"))
    y, x = F.col("cell_lat"), F.col("cell_lon")
    (y0, x0), (y1, x1), (y2, x2) = [(F.col(f"lat{n}"), F.col(f"lon{n}")) for n in range(3)]
    area = (y1 - y2) * (x0 - x2) + (x2 - x1) * (y0 - y2)
    cells = (cells.withColumn("_a", area).where(F.abs("_a") > 1e-15)
             .withColumns({"_u": ((y1 - y2) * (x - x2) + (x2 - x1) * (y - y2)) / F.col("_a"),
                           "_v": ((y2 - y0) * (x - x2) + (x0 - x2) * (y - y2)) / F.col("_a")})
             .withColumn("_w", 1 - F.col("_u") - F.col("_v"))
             .where(F.least("_u", "_v", "_w") >= -1e-9))
    inside = cells.select(*CELL, (F.col("_u") * F.col("value0") + F.col("_v") * F.col("value1")
                                  + F.col("_w") * F.col("value2")).alias("value"), F.lit(False).alias("near"))
    near = candidate_cells(ok, grid, max_distance).select(*CELL, F.lit(None).cast("double").alias("value"),
                                                          F.lit(True).alias("near"))
    merged = inside.unionByName(near).groupBy(*CELL).agg(F.avg("value").alias("value"), F.max("near").alias("near"))
    kept = merged.where(F.col("near") & F.col("value").isNotNull()).drop("near")
    return _one(kept.where(F.col("value") >= 0) if drop_negative else kept)


def overwrite_regrid(pixels: DataFrame, grid: GridSpec, max_distance: float = 0.1) -> DataFrame:
    """Every cell within a whole number of cells of a pixel takes the last such pixel's value."""
    radius = max(1, -(-float(max_distance) // grid.cell_deg)) * grid.cell_deg
    pairs = candidate_cells(valid_pixels(pixels), grid, radius)
    return _one(pairs.groupBy(*CELL).agg(F.max_by("value", "pixel_id").alias("value")))


def _far_counts(ok: DataFrame, limit: Column) -> DataFrame:
    """Per granule: pixels ``n``, how many have no other pixel within ``limit`` (``far``), and the smallest of those pixels' distances.

    No distance is sorted. Pixels are put in buckets of diagonal ``limit``. Two pixels in one
    bucket are both closer than that, and a counted aggregate settles them; only pixels
    alone in their bucket look for a neighbour, and a pixel can lie near a bounded
    number of lonely ones, so the pairs grow with the pixels, not with their square.
    Distances are looked up to twice the limit; a pixel without a neighbour there has an infinite one.
    """
    ok = ok.select("granule_id", "pixel_id", "lat", "lon", limit.alias("_limit"))
    side, reach = F.col("_limit") / 2 ** 0.5, 2 * F.col("_limit")
    buckets = (ok.groupBy("granule_id", F.floor(F.col("lat") / side).alias("_y"), F.floor(F.col("lon") / side).alias("_x"))
               .agg(F.count("*").alias("n"), *[F.min(c).alias(f"own_{c}") for c in ("pixel_id", "lat", "lon")],
                    F.min("_limit").alias("_limit")))
    lonely = buckets.where(F.col("n") == 1)
    # The search uses wider squares, so a lonely pixel looks into nine of them.
    square = [F.floor(F.col(c) / reach) for c in ("lat", "lon")]
    around = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    probes = (lonely.withColumn("_o", F.explode(offsets_array(around)))
              .select("granule_id", "own_pixel_id", "own_lat", "own_lon",
                      (F.floor(F.col("own_lat") / reach) + F.col("_o.dr")).alias("_y"),
                      (F.floor(F.col("own_lon") / reach) + F.col("_o.dc")).alias("_x")))
    met = (ok.withColumns({"_y": square[0], "_x": square[1]}).join(probes, ["granule_id", "_y", "_x"])
           .where(F.col("pixel_id") != F.col("own_pixel_id")).groupBy("granule_id", "own_pixel_id")
           .agg(F.min(F.hypot(F.col("lat") - F.col("own_lat"), F.col("lon") - F.col("own_lon"))).alias("d"),
                F.min("_limit").alias("_within"))
           .where(F.col("d") <= 2 * F.col("_within")).drop("_within"))
    # A lonely pixel with nothing in reach is farther than twice the limit from its neighbour.
    d = F.coalesce(F.col("d"), F.lit(float("inf")))
    spaced = (lonely.select("granule_id", "own_pixel_id", "_limit").join(met, ["granule_id", "own_pixel_id"], "left")
              .groupBy("granule_id").agg(F.count_if(d > F.col("_limit")).alias("far"),
                                         F.min(F.when(d > F.col("_limit"), d)).alias("above")))
    sized = buckets.groupBy("granule_id").agg(F.sum("n").alias("n"))
    return sized.join(spaced, "granule_id", "left").withColumn("far", F.coalesce("far", F.lit(0)))


def coarse_granules(pixels: DataFrame, grid: GridSpec, max_distance: float = 0.1) -> DataFrame:
    """Granules whose median nearest-pixel spacing exceeds 1.5 grid steps: ``granule_id, coarse``.

    Only the comparison with the threshold T is needed, so pixels farther than T from all others
    are counted. Where they are exactly half, the median lies halfway between the smallest distance above T
    and the largest one not above; it exceeds T if that lower one exceeds 2T less the upper one, that is, if a
    count at this second threshold finds more pixels. Only such granules are counted twice.
    A granule with a single pixel takes ``max_distance`` as its spacing.
    """
    limit = 1.5 * min(grid.lat_step, grid.lon_step)
    ok = valid_pixels(pixels)
    counts = fact_table(_far_counts(ok, F.lit(limit)), "spacing")
    second = 2 * F.lit(limit) - F.col("above")
    half = (F.col("n") > 1) & (2 * F.col("far") == F.col("n"))
    ties = fact_table(counts.where(half & (second > 0)).select("granule_id", F.col("far").alias("far_at_limit"), second.alias("_second")), "ties")
    again = (_far_counts(ok.join(ties, "granule_id"), F.col("_second")).select("granule_id", F.col("far").alias("_far"))
             .join(ties, "granule_id").select("granule_id", (F.col("_far") > F.col("far_at_limit")).alias("tie")))
    # At or below a second threshold of 0 any distance between different places is larger.
    return counts.join(again, "granule_id", "left").select(
        "granule_id",
        F.when(F.col("n") == 1, F.lit(max_distance > limit))
        .when(half, F.coalesce(F.col("tie"), F.lit(True))).otherwise(2 * F.col("far") > F.col("n")).alias("coarse"))


def griddata_regrid(pixels: DataFrame, grid: GridSpec, max_distance: float = 0.1) -> DataFrame:
    """Linear on the mesh, or pixel overwrite for granules coarser than the grid. The choice is
    made once, one row a granule, and meets the pixels in each branch."""
    tagged = pixels.join(fact_table(coarse_granules(pixels, grid, max_distance), "coarse"), "granule_id")
    return (overwrite_regrid(tagged.where("coarse"), grid, max_distance)
            .unionByName(linear_regrid(tagged.where("not coarse"), grid, max_distance, drop_negative=False)))


METHODS = {"griddata": griddata_regrid, "kdtree": nearest_regrid, "rbf": smooth_regrid}


def interpolate(pixels: DataFrame, grid: GridSpec, method: str = "griddata", max_distance: float = 0.1,
                qa_threshold: float | None = None) -> DataFrame:
    """One of the point methods by name. With ``qa_threshold``, values of lower quality are emptied before any method."""
    if qa_threshold is not None:
        pixels = pixels.withColumn("value", F.when(F.col("qa") >= qa_threshold, F.col("value")))
    if method not in METHODS:
        raise ValueError(f"unknown interpolation method {method!r}; known: {sorted(METHODS)}")
    return METHODS[method](pixels, grid, max_distance)


def search_radius(pixels: DataFrame, grid: GridSpec) -> DataFrame:
    """Radius by pixel count: 2 cells below 100, 3 below 500, else 4 (mean cell size)."""
    n = F.col("n_valid")
    return (valid_pixels(pixels).groupBy("granule_id").agg(F.count("*").alias("n_valid"))
            .withColumn("radius", F.when(n < 100, 2).when(n < 500, 3).otherwise(4) * F.lit(grid.cell_deg)))


def regrid_by_density(pixels: DataFrame, grid: GridSpec, method: str = "rbf") -> DataFrame:
    """Nearest or smooth gridding with each granule's own search radius."""
    if method not in ("kdtree", "rbf"):
        raise ValueError("method must be 'kdtree' or 'rbf'")
    sized = pixels.join(fact_table(search_radius(pixels, grid).select("granule_id", "radius"), "radius"), "granule_id")
    if method == "kdtree":
        return nearest_regrid(sized, grid, F.col("radius"), most=4 * grid.cell_deg)
    return smooth_regrid(sized, grid, F.col("radius"))


# -- adaptive choice --------------------------------------------------------------

def granule_stats(pixels: DataFrame, grid: GridSpec) -> DataFrame:
    """Valid count, extent, density (pixels per cell) and share of the grid's extent."""
    stats = valid_pixels(pixels).groupBy("granule_id").agg(
        F.count("*").alias("n_valid"), F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"))
    extent = (grid.nlat - 1) * grid.lat_step * (grid.nlon - 1) * grid.lon_step
    return stats.withColumns({
        "density": F.col("n_valid") / F.lit(float(grid.size)),
        "extent_ratio": (F.col("lat_max") - F.col("lat_min")) * (F.col("lon_max") - F.col("lon_min")) / F.lit(extent)})


def choose_method(density: Column, extent_ratio: Column) -> Column:
    return (F.when((density > 0.1) & (extent_ratio > 0.3), "linear")
            .when(density > 0.01, "idw").otherwise("nearest"))


def adaptive_regrid(pixels: DataFrame, grid: GridSpec) -> DataFrame:
    """Linear, distance-weighted or nearest by the density and extent of each granule."""
    ok = drop_zero_fill(valid_pixels(pixels))
    chosen = granule_stats(ok, grid).select("granule_id", choose_method(F.col("density"), F.col("extent_ratio"))
                                            .alias("method"))
    tagged = ok.join(fact_table(chosen, "methods"), "granule_id")
    branches = {"linear": linear_regrid, "idw": idw_regrid, "nearest": nearest_limited}
    parts = [op(tagged.where(F.col("method") == name), grid).withColumn("method", F.lit(name))
             for name, op in branches.items()]
    return reduce(DataFrame.unionByName, parts)


# -- daily nearest pixel within its own footprint ---------------------------------

# Fixed value: widest footprint half-spacing, in degrees.
FOOTPRINT_CAP_DEG = 0.35


def scanline_step(pixels: DataFrame) -> DataFrame:
    """Each pixel with its distance to the next column; the last column repeats the one before."""
    near = gather(pixels, ["granule_id"], "row_idx", "col_idx",
                  {"own": (0, 0), "next": (0, 1), "prev": (0, -1)}, ["lat", "lon"])

    def step(a: str, b: str) -> Column:
        dx = (F.col(f"{b}_lon") - F.col(f"{a}_lon")) * F.cos(F.radians(F.col(f"{a}_lat")))
        return F.hypot(F.col(f"{b}_lat") - F.col(f"{a}_lat"), dx)

    steps = near.where(F.col("own_lat").isNotNull()).select(
        "granule_id", "row_idx", "col_idx", F.coalesce(step("own", "next"), step("prev", "own")).alias("step"))
    return pixels.join(steps, ["granule_id", "row_idx", "col_idx"])


def footprint_radius(pixels: DataFrame, resolution: float, cap: float = FOOTPRINT_CAP_DEG) -> DataFrame:
    """Half the spacing to the next column, at least half a cell diagonal, at most ``cap``."""
    floor = 0.5 * resolution * 2 ** 0.5
    return scanline_step(pixels).withColumn(
        "radius", F.least(F.greatest(0.5 * F.col("step"), F.lit(floor)), F.lit(float(cap)))).drop("step")


def footprint_nn_daily(pixels: DataFrame, grid: GridSpec, cap: float = FOOTPRINT_CAP_DEG) -> DataFrame:
    """All granules of a day pooled: the nearest valid pixel, if the cell lies in its footprint.

    Only pixels within ``cap`` can be accepted, so the search stops there.
    """
    ok = valid_pixels(footprint_radius(pixels, grid.lat_step, cap)).withColumn("obs_date", F.to_date("obs_time"))
    scale = fact_table(ok.groupBy("obs_date").agg(F.cos(F.radians(F.avg("lat"))).alias("lon_scale")), "day-scale")
    best = outward_nearest(ok.join(scale, "obs_date"), grid, ["obs_date"], "pixel_id", ["value", "radius"], cap, lon_scale=F.col("lon_scale"))
    return best.where(F.col("d") <= F.col("radius")).select("obs_date", "i", "j", "value")


# -- grid to grid -----------------------------------------------------------------

def smooth_box(cube: DataFrame, grid: GridSpec, keys, k: int = 3) -> DataFrame:
    """k x k box mean with wrap-around; a hole anywhere in the box leaves the cell empty."""
    if k % 2 == 0:
        raise ValueError("kernel size must be odd")
    half = k // 2
    around = [(a, b) for a in range(-half, half + 1) for b in range(-half, half + 1)]
    sent = (cube.where(is_finite(F.col("value"))).select(*keys, "i", "j", "value")
            .withColumn("_o", F.explode(offsets_array(around)))
            .withColumns({"i": F.pmod(F.col("i") + F.col("_o.dr"), F.lit(grid.nlat)).cast("int"),
                          "j": F.pmod(F.col("j") + F.col("_o.dc"), F.lit(grid.nlon)).cast("int")}))
    return (sent.groupBy(*keys, "i", "j").agg(F.sum("value").alias("_s"), F.count("*").alias("_n"))
            .where(F.col("_n") == k * k).select(*keys, "i", "j", (F.col("_s") / (k * k)).alias("value")))


def sample_pixels(pixels: DataFrame, n: int = 5000) -> DataFrame:
    """A reproducible random ``n`` pixels per granule: the first ``n`` in hash order.

    A histogram of the leading 16 hash bits finds how far each granule must be read,
    so the ordered step sees ``n`` rows and one 65536th of a granule, never all of it.
    """
    keyed = pixels.withColumn("_h", F.md5(F.col("pixel_id").cast("string")))
    keyed = keyed.withColumn("_bin", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    bins = keyed.groupBy("granule_id", "_bin").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("granule_id").orderBy("_bin")
                                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    needed = bins.withColumn("_before", before).where(F.col("_before") < n).select("granule_id", "_bin")
    order = Window.partitionBy("granule_id").orderBy("_h", "pixel_id")
    return (keyed.join(needed, ["granule_id", "_bin"], "left_semi")
            .withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n)
            .drop("_h", "_bin", "_rn").select(*pixels.columns))
