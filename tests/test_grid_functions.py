from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.functions import geo, lookup
from skygrid.functions import time as tm
from skygrid.plans.grid import FIGURE_BOX, GridSpec, km_to_deg_lon


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


# -- grids -------------------------------------------------------------------------

def test_published_shapes():
    box = GridSpec.from_km((5.5, 3.5))
    assert (box.nlat, box.nlon) == (224, 113)
    assert (box.crop(FIGURE_BOX).nlat, box.crop(FIGURE_BOX).nlon) == (159, 74)
    wide = GridSpec.from_km((8.0, 3.5))
    assert (wide.nlat, wide.nlon) == (224, 78) and (wide.crop(FIGURE_BOX).nlat, wide.crop(FIGURE_BOX).nlon) == (159, 51)
    merged, binned = GridSpec.from_degrees(FIGURE_BOX, 0.1), GridSpec.from_degrees(FIGURE_BOX, 0.1, 0.5)
    assert (merged.nlat, merged.nlon) == (52, 41) and (binned.nlat, binned.nlon) == (51, 41)


def test_cells_and_crop_share_coordinates(spark):
    grid = GridSpec.from_km((55.0, 35.0))
    crop = grid.crop(FIGURE_BOX)
    rows = crop.cells(spark).collect()
    assert len(rows) == crop.size
    for r in rows:
        assert r.lat == pytest.approx(grid.lats()[r.i + crop.i0]) and r.lon == pytest.approx(grid.lons()[r.j + crop.j0])
        assert 119 <= r.lon <= 123 and 21 <= r.lat <= 26


def test_last_edge_belongs_to_last_cell(spark):
    grid = GridSpec(0.5, 1.0, 3, 0.5, 1.0, 2)
    points = {-0.1: None, 0.0: 0, 0.999: 0, 1.0: 1, 2.0: 2, 3.0: 2, 3.0001: None}
    for x, want in points.items():
        assert one(spark, grid.row_index(F.lit(x))) == want


def test_index_agrees_with_digitize(spark):
    grid = GridSpec(20.8763171, 0.1, 37, 118.3, 0.07, 41)
    rng = np.random.default_rng(3)
    xs = np.concatenate([rng.uniform(20, 25, 400), grid.lat_edge0 + np.arange(38) * 0.1])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double").select("x", grid.row_index(F.col("x")).alias("i"))
    edges = grid.lat_edge0 + np.arange(38) * 0.1
    for r in df.collect():
        k = int(np.digitize(r.x, edges)) - 1
        k = 36 if r.x == edges[-1] else k
        assert r.i == (k if 0 <= k < 37 else None)


def test_nearest_index_tie_and_clamp(spark):
    grid = GridSpec(0.0, 1.0, 3, 0.0, 1.0, 3)
    for x, want in {-5.0: 0, 0.5: 0, 0.51: 1, 1.5: 1, 9.0: 2}.items():
        assert one(spark, grid.nearest_row(F.lit(x))) == want


def test_signature_tells_grids_apart():
    assert GridSpec(0, 1, 3, 0, 1, 3).signature() != GridSpec(0, 1, 4, 0, 1, 3).signature()


def test_km_to_deg():
    assert km_to_deg_lon(100, 89.95) == 0.0
    assert km_to_deg_lon(111.19492664455873, 0) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        GridSpec.from_km((5.5, 3.5), (0, 1, 89.91, 90.0))


# -- times -------------------------------------------------------------------------

NAMES = {
    "S5P_OFFL_L2__HCHO___20241231T033759_20241231T051929_37.nc": datetime(2024, 12, 31, 5, 19, 29),
    "S5P_OFFL_L2__NO2____20240102T045523_x.nc": datetime(2024, 1, 2, 4, 55, 23),
    "MOD04_L2.A2025001.0210.061.2025001180158.hdf": datetime(2025, 1, 1, 2, 10),
    "MCD19A2.A2024366.h29v06.061.2025003055754.hdf": datetime(2024, 12, 31),
    "GK2_GEMS_L2_20230515_0345_NO2_FW_DPRO_ORI.nc": datetime(2023, 5, 15, 3, 45),
    "map_20230515.png": datetime(2023, 5, 15),
    "map_20230515_123456.png": datetime(2023, 5, 15),
    "map_2023-05-15.png": datetime(2023, 5, 15),
    "map_2023-05-15T10:11:12.png": datetime(2023, 5, 15),
    "map.png": None,
    "map_99999999.png": None,
}


def test_granule_time(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string").select("name", tm.granule_time(F.col("name")).alias("t"))
    assert {r.name: r.t for r in df.collect()} == NAMES


def test_other_name_dates(spark):
    assert one(spark, tm.gems_time(F.lit("x_20230515_0345_y"))) == datetime(2023, 5, 15, 3, 45)
    assert one(spark, tm.gems_time(F.lit("20230515_0345"))) is None
    assert one(spark, tm.slice_date(F.lit("cube_19990101_20230515.nc"))) == date(2023, 5, 15)
    assert one(spark, tm.l3_date(F.lit("S5P-L3-20230515-20240601.nc"))) == date(2023, 5, 15)
    assert one(spark, tm.l3_date(F.lit("20230516-20240601-x.nc"))) == date(2023, 5, 16)


def test_local_time_and_day_window(spark):
    t = F.lit("2024-01-01 20:00:00").cast("timestamp")
    assert one(spark, tm.to_local(t)) == datetime(2024, 1, 2, 4)
    assert one(spark, tm.local_day_window(t, "2024-01-02", "2024-01-02")) is True
    assert one(spark, tm.local_day_window(t, "2024-01-01", "2024-01-01")) is False
    west = F.lit("2024-01-02 03:00:00").cast("timestamp")
    assert one(spark, tm.local_day_window(west, "2024-01-01", "2024-01-01", "America/Lima")) is True


def test_range_end_rules(spark):
    late = F.lit("2024-01-31 18:00:00").cast("timestamp")
    assert one(spark, tm.in_date_range(late, "2024-01-01", "2024-01-31")) is True
    assert one(spark, tm.in_date_range(late, "2024-01-01", "2024-01-31", end_at_midnight=True)) is False
    assert one(spark, tm.in_date_range(late, "2024-01-01", "2024-01-31 12:00:00")) is False


def test_normalize_range(spark):
    def c(s):
        return F.lit(s).cast("timestamp")
    lo, hi = tm.normalize_range(c("2024-03-01"), c("2024-02-01"), c("2024-02-20"))
    assert one(spark, F.struct(lo.alias("a"), hi.alias("b"))) == (datetime(2024, 2, 1, 23, 59, 59), datetime(2024, 2, 20))


def test_periods(spark):
    d = F.lit("2024-01-15 05:00:00").cast("timestamp")
    want = {"day": date(2024, 1, 15), "month": date(2024, 1, 1), "year": date(2024, 1, 1), "season": date(2023, 12, 1)}
    for period, start in want.items():
        assert one(spark, tm.period_start(d, period)) == start
    with pytest.raises(ValueError):
        tm.period_start(d, "decade")
    assert one(spark, tm.half_year_period(F.lit("2024-07-01").cast("date"))[2]) == "20240701-20241231"
    assert one(spark, tm.bucket_label(d, "per_file")) == "2024-01-15 05:00"


# -- scalars -----------------------------------------------------------------------

def test_decode_and_finite(spark):
    assert one(spark, geo.decode(F.lit(1500))) == pytest.approx(1.5)
    assert one(spark, geo.decode(F.lit(-9999))) is None and one(spark, geo.decode(F.lit(-5))) is None
    for bad in ("nan", "inf", "-inf"):
        assert one(spark, geo.finite(F.lit(float(bad)))) is None


def test_sinusoidal_corner(spark):
    """Tile h18v09 starts on the equator at the meridian."""
    lat, lon = geo.sinusoidal_to_lonlat(F.lit(18), F.lit(9), F.lit(0), F.lit(0))
    assert one(spark, lat) == pytest.approx(0.0, abs=1e-6) and one(spark, lon) == pytest.approx(0.0, abs=1e-6)
    lat, lon = geo.sinusoidal_to_lonlat(F.lit(28), F.lit(6), F.lit(1199), F.lit(0))
    assert one(spark, lat) == pytest.approx(20.0, abs=1e-5) and one(spark, lon) == pytest.approx(100 / np.cos(np.radians(20)), abs=1e-3)


def test_tile_and_size(spark):
    h, v = geo.tile_hv(F.lit("MCD19A2.A2025001.h28v07.061.hdf"))
    assert (one(spark, h), one(spark, v)) == (28, 7)
    h, v = geo.tile_hv(F.lit("no tile"))
    assert (one(spark, h), one(spark, v)) == (29, 6)
    sizes = {1023: "1023 B", 1024: "1.00 KB", 15_999: "15.62 KB", 5 * 1024 ** 2: "5.00 MB", 3 * 1024 ** 3: "3.00 GB"}
    for n, text in sizes.items():
        assert one(spark, geo.readable_size(F.lit(n).cast("long"))) == text


def test_weights(spark):
    assert one(spark, geo.cell_weight(F.lit(60.0), "area")) == pytest.approx(0.5)
    with pytest.raises(ValueError):
        geo.cell_weight(F.lit(1.0), "volume")


def test_lookups(spark):
    assert one(spark, lookup.gems_code(F.lit("AOD"))) == "AERAOD" and one(spark, lookup.gems_code(F.lit("AERAOD"))) == "AERAOD"
    assert one(spark, lookup.gems_code(F.lit("XYZ"))) is None
    assert one(spark, lookup.l3_product_id(F.lit("so2-7km"))) == "so2-7km" and one(spark, lookup.l3_product_id(F.lit("SO2"))) == "so2-7km"
    assert one(spark, lookup.hub_column(F.lit("Sentinel-5P"))) == "sentinel5p" and lookup.hub_key("S3") == "sentinel3"
    assert one(spark, lookup.variable_abbreviation(F.lit("Snow_depth"))) == "sno"
    assert lookup.resolution_for("CH4___") == (5.5, 7.0) and lookup.resolution_for("CO") == (5.5, 7.0)
    assert lookup.resolution_for("nothing") == (5.5, 3.5) and lookup.resolution_for("CO", (1, 2)) == (1, 2)
    with pytest.raises(ValueError):
        lookup.hub_key("mars")


def test_product_tables(spark):
    rows = {r.product: r for r in lookup.product_config(spark).union(lookup.gems_product_config(spark)).collect()}
    assert rows["NO2___"].vmax == 2e-4 and rows["O3__PR"].res_x_km == 30.0 and rows["UVI"].cmap == "magma"
    assert rows["CO____"].vmin is None and rows["SO2"].title == "GEMS SO₂ Column"
