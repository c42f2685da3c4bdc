"""Product, hub, variable and zone tables, and the column lookups over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.plans.dimension import dimension

# Product codes, levels and classes of the swath mission.
PRODUCT_TYPES = ("O3____", "O3_TCL", "O3__PR", "CH4___", "CO____", "NO2___",
                 "HCHO__", "SO2___", "CLOUD_", "FRESCO", "AER_LH", "AER_AI")
PRODUCT_LEVELS = ("L0__", "L1B_", "L2__")
PRODUCT_CLASSES = ("NRTI", "OFFL", "RPRO", "TEST", "OGCA", "GSOV", "OPER")

# Products by group.
PRODUCT_GROUPS = {
    "ozone": ("O3____", "O3_TCL", "O3__PR"),
    "gas": ("NO2___", "SO2___", "CO____", "CH4___", "HCHO__"),
    "cloud_aerosol": ("CLOUD_", "FRESCO", "AER_LH", "AER_AI"),
}

# Product, display name, variable, units, display range, resolution (x km, y km), title, colour map.
PRODUCT_CONFIG = (
    ("O3____", "O₃", "ozone_total_vertical_column", "O$_3$ Total Vertical Column (mol/m$^2$)", 0.1, 0.11, 5.5, 3.5,
     "O$_3$ Total Vertical Column", "RdBu_r"),
    ("O3_TCL", "O₃_TCL", "ozone_tropospheric_column", "O$_3$ Tropospheric Column (mol/m$^2$)", 0.1, 0.2, 5.5, 3.5,
     "O$_3$ Tropospheric Column", "RdBu_r"),
    ("O3__PR", "O₃_PR", "ozone_tropospheric_column", "O$_3$ Tropospheric Column (mol/m$^2$)", 0.01, 0.04, 30.0, 30.0,
     "O$_3$ Tropospheric Column", "jet"),
    ("CH4___", "CH₄", "methane_mixing_ratio", "CH$_4$ Methane Mixing Ratio", None, None, 5.5, 7.0,
     "CH$_4$ Methane Mixing Ratio", "RdBu_r"),
    ("CO____", "CO", "carbonmonoxide_total_column", "CO Total Column (mol/m$^2$)", None, None, 5.5, 7.0,
     "CO Total Column (mol/m$^2$)", "RdBu_r"),
    ("NO2___", "NO₂", "nitrogendioxide_tropospheric_column", "NO$_2$ Tropospheric Column (mol/m$^2$)", -2e-4, 2e-4, 5.5, 3.5,
     "NO$_2$ Tropospheric Column", "RdBu_r"),
    ("HCHO__", "HCHO", "formaldehyde_tropospheric_vertical_column", "HCHO Tropospheric Vertical Column (mol/m$^2$)",
     -4e-4, 4e-4, 5.5, 3.5, "HCHO Tropospheric Vertical Column", "RdBu_r"),
    ("SO2___", "SO₂", "sulfurdioxide_total_vertical_column", "SO$_2$ Total Vertical Column (mol/m$^2$)", -4e-3, 4e-3, 5.5, 3.5,
     "SO$_2$ Total Vertical Column", "RdBu_r"),
    ("AER_AI", "Aerosol Index", "aerosol_index_340_380", "Aerosol Index", None, None, 5.5, 3.5, "Aerosol Index", "viridis"),
)
PRODUCT_CONFIG_SCHEMA = ("product string, display_name string, dataset_name string, units string, vmin double, vmax double, "
                         "res_x_km double, res_y_km double, title string, cmap string")

# The geostationary mission's products, all on its own resolution.
GEMS_RESOLUTION_KM = (8.0, 3.5)
GEMS_PRODUCT_CONFIG = (
    ("NO2", "NO₂", "ColumnAmountNO2", "molecules cm-2", 0.0, 1.0e16, 8.0, 3.5, "GEMS NO₂ Total Column", "turbo"),
    ("O3T", "O₃", "ColumnAmountO3", "DU", 200.0, 400.0, 8.0, 3.5, "GEMS O₃ Total Column", "viridis"),
    ("HCHO", "HCHO", "ColumnAmountHCHO", "molecules cm-2", 0.0, 2.0e16, 8.0, 3.5, "GEMS HCHO Column", "turbo"),
    ("SO2", "SO₂", "ColumnAmountSO2", "molecules cm-2", 0.0, 1.0e16, 8.0, 3.5, "GEMS SO₂ Column", "turbo"),
    ("AERAOD", "AOD", "FinalAerosolOpticalDepth", "unitless", 0.0, 2.0, 8.0, 3.5, "GEMS Aerosol Optical Depth", "YlOrBr"),
    ("UVI", "UVI", "UVIndex", "unitless", 0.0, 12.0, 8.0, 3.5, "GEMS UV Index", "magma"),
)
AEROSOL_WAVELENGTHS_NM = (354, 443, 550)

# Friendly name to product code, and default versions.
GEMS_PRODUCT_CODES = {
    "NO2": "NO2", "O3": "O3T", "O3T": "O3T", "O3P": "O3P", "HCHO": "HCHO", "CHOCHO": "CHOCHO",
    "SO2": "SO2", "AOD": "AERAOD", "AERAOD": "AERAOD", "UVI": "UVI", "AEH": "AEH", "CLOUD": "CLOUD",
}
DEFAULT_VERSIONS = {"NO2": "v4.0.1"}

# Swath product to ready-made grid product.
L3_PRODUCT_IDS = {
    "NO2___": "no2-tropospheric", "NO2": "no2-tropospheric", "O3____": "o3", "O3": "o3",
    "HCHO__": "hcho", "HCHO": "hcho", "SO2___": "so2-7km", "SO2": "so2-7km", "CO____": "co", "CO": "co",
    "CH4___": "ch4", "CH4": "ch4", "AER_AI": "aai", "AER_LH": "alh",
}

# Reanalysis variable abbreviations.
VARIABLE_ABBREVIATIONS = {
    "relative_humidity": "rh", "temperature": "t", "u_component_of_wind": "u", "v_component_of_wind": "v",
    "10m_u_component_of_wind": "u10", "10m_v_component_of_wind": "v10", "2m_temperature": "t2m",
    "2m_dewpoint_temperature": "d2m", "boundary_layer_height": "blh", "surface_pressure": "sp",
    "total_column_water_vapour": "tcwv",
}

# Resolution (x km, y km) by gas name, used where the catalog has no own entry.
GAS_RESOLUTION_KM = {
    "NO2": (5.5, 3.5), "O3": (5.5, 3.5), "SO2": (5.5, 3.5), "CO": (5.5, 7.0), "CH4": (5.5, 7.0),
    "HCHO": (5.5, 3.5), "AER_AI": (5.5, 3.5), "AER_LH": (5.5, 3.5), "O3_PROFILE": (30.0, 30.0),
}
DEFAULT_RESOLUTION_KM = (5.5, 3.5)

# Preferred optical-depth variables, best first.
SWATH_AOD_VARIABLES = ("AOD_550_Dark_Target_Deep_Blue_Combined", "Optical_Depth_Land_And_Ocean",
                       "Image_Optical_Depth_Land_And_Ocean")
TILE_AOD_VARIABLES = ("Optical_Depth_047", "Optical_Depth_055")

# Named boxes, zones as county lists, and minutes per slot interval.
REGIONS = {"taiwan": (118.0, 124.0, 20.0, 27.0), "east_asia": (100.0, 150.0, 0.0, 50.0)}
AIR_QUALITY_ZONES = {
    "north": ("臺北市", "新北市", "基隆市", "桃園市", "宜蘭縣"),
    "zhumiao": ("新竹縣", "新竹市", "苗栗縣"),
    "central": ("臺中市", "彰化縣", "南投縣", "雲林縣"),
    "yunchianan": ("嘉義縣", "嘉義市", "臺南市"),
    "kaoping": ("高雄市", "屏東縣"),
}
SLOT_MINUTES = {"10min": 10, "30min": 30, "1hour": 60, "3hour": 180, "6hour": 360, "12hour": 720, "daily": 1440}

# Thermal power plants (name, lat, lon, owner type).
POWER_PLANTS = (
    ("林口", 25.08, 121.28, "台電火力"), ("大潭", 25.04, 121.03, "台電火力"),
    ("通霄", 24.48, 120.70, "台電火力"), ("台中", 24.21, 120.48, "台電火力"),
    ("興達", 22.87, 120.26, "台電火力"), ("大林", 22.55, 120.40, "台電火力"),
    ("協和", 25.13, 121.74, "台電火力"), ("南部", 22.91, 120.20, "台電火力"),
    ("和平", 24.30, 121.74, "民營火力"), ("新桃", 24.95, 121.18, "民營火力"),
    ("星元", 24.18, 120.42, "民營火力"), ("星能", 24.15, 120.43, "民營火力"),
    ("嘉惠", 23.47, 120.27, "民營火力"), ("豐德", 22.67, 120.45, "民營火力"),
    ("塔山", 23.54, 119.59, "台電火力"), ("尖山", 26.18, 119.97, "台電火力"),
)

# Default monitoring stations.
STATIONS = (("FS", 22.6294, 120.3461), ("NZ", 22.7422, 120.3339), ("TH", 24.1817, 120.5956), ("TP", 25.0330, 121.5654))


@dataclass(frozen=True)
class HubSpec:
    """How one source names its coordinates and variables."""

    key: str
    layout: str = "year_month"
    lat_names: tuple[str, ...] = ("latitude", "lat")
    lon_names: tuple[str, ...] = ("longitude", "lon")
    time_names: tuple[str, ...] = ("time",)
    level: str | None = None
    variables: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


# The sources and the variable (or its accepted aliases) of each product.
HUBS = {
    "sentinel5p": HubSpec("sentinel5p", level="L2", variables={
        "NO2___": ("nitrogendioxide_tropospheric_column",), "O3____": ("ozone_total_vertical_column",),
        "SO2___": ("sulfurdioxide_total_vertical_column",),
        "HCHO__": ("formaldehyde_tropospheric_vertical_column",), "CH4___": ("methane_mixing_ratio",),
        "CO____": ("carbonmonoxide_total_column",), "AER_AI": ("aerosol_index_354_388", "aerosol_index_340_380")}),
    "sentinel3": HubSpec("sentinel3", level="L2"),
    "gems": HubSpec("gems", variables={"NO2": ("ColumnAmountNO2",), "O3T": ("ColumnAmountO3",),
                                       "HCHO": ("ColumnAmountHCHO",), "SO2": ("ColumnAmountSO2",)}),
    "modis": HubSpec("modis", layout="flat", lat_names=("lat", "latitude"), lon_names=("lon", "longitude"),
                     variables={p: ("aod",) for p in ("MYD04_L2", "MOD04_L2", "MCD19A2",
                                                      "MYD04_L2_binned", "MOD04_L2_binned")}),
    "era5": HubSpec("era5", layout="flat", time_names=("time", "valid_time")),
    "himawari": HubSpec("himawari"),
}
HUB_ALIASES = {"s5p": "sentinel5p", "s3": "sentinel3"}


def hub_key(name: str) -> str:
    """Canonical hub name: case, dashes and underscores do not matter."""
    key = name.lower().replace("-", "").replace("_", "")
    key = HUB_ALIASES.get(key, key)
    if key not in HUBS:
        raise ValueError(f"unknown hub {name!r}; known: {sorted(HUBS)}")
    return key


def map_lookup(key: Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    """Value of a small fixed map, ``default`` (or null) for other keys."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, default)


def gems_code(name: Column) -> Column:
    """Friendly name to product code; codes pass through, anything else is null."""
    codes = {**{c: c for c in GEMS_PRODUCT_CODES.values()}, **GEMS_PRODUCT_CODES}
    return map_lookup(name, codes)


def l3_product_id(product: Column) -> Column:
    return map_lookup(product, L3_PRODUCT_IDS, product)


def hub_column(name: Column) -> Column:
    key = F.regexp_replace(F.lower(name), "[-_]", "")
    return map_lookup(map_lookup(key, HUB_ALIASES, key), {k: k for k in HUBS})


def variable_abbreviation(name: Column) -> Column:
    return map_lookup(name, VARIABLE_ABBREVIATIONS, F.lower(F.substring(name, 1, 3)))


def validate_inputs(product: Column, level: Column, product_class: Column) -> Column:
    """Struct of three membership flags."""
    return F.struct(product.isin(*PRODUCT_TYPES).alias("product_type"),
                    level.isin(*PRODUCT_LEVELS).alias("product_level"),
                    product_class.isin(*PRODUCT_CLASSES).alias("product_class"))


def product_group(product: Column) -> Column:
    return map_lookup(product, {p: g for g, ps in PRODUCT_GROUPS.items() for p in ps})


def product_config(spark: SparkSession) -> DataFrame:
    return dimension(spark, PRODUCT_CONFIG, PRODUCT_CONFIG_SCHEMA)


def gems_product_config(spark: SparkSession) -> DataFrame:
    return dimension(spark, GEMS_PRODUCT_CONFIG, PRODUCT_CONFIG_SCHEMA)


def with_product_info(df: DataFrame, product: str = "product") -> DataFrame:
    """Attach the catalog row of each product; unknown products keep null attributes."""
    return df.join(product_config(df.sparkSession).withColumnRenamed("product", product), product, "left")


def resolution_for(product: str | None, resolution: tuple[float, float] | None = None) -> tuple[float, float]:
    """Explicit argument, else a catalog entry that differs from the default, else the gas table."""
    if resolution is not None:
        return resolution
    listed = {row[0]: (row[6], row[7]) for row in PRODUCT_CONFIG}.get(product, DEFAULT_RESOLUTION_KM)
    return listed if listed != DEFAULT_RESOLUTION_KM else GAS_RESOLUTION_KM.get(product, DEFAULT_RESOLUTION_KM)


def resolution_columns(product: Column) -> tuple[Column, Column]:
    """``resolution_for`` over a column: (x km, y km)."""
    known = {**GAS_RESOLUTION_KM, **{row[0]: resolution_for(row[0]) for row in PRODUCT_CONFIG}}

    def part(k: int) -> Column:
        pairs = [F.lit(x) for name, res in known.items() for x in (name, float(res[k]))]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), product), F.lit(DEFAULT_RESOLUTION_KM[k]))
    return part(0), part(1)


def first_present(wanted: Sequence[str], available: Sequence[str], fallback_to_first: bool = False) -> str | None:
    """First wanted name that exists; optionally the first available one."""
    for name in wanted:
        if name in available:
            return name
    return available[0] if fallback_to_first and available else None


def zone_counties(spark: SparkSession, zones: Mapping[str, Sequence[str]] = AIR_QUALITY_ZONES) -> DataFrame:
    return dimension(spark, [(z, c) for z, cs in zones.items() for c in cs], "zone string, county string")


def stations(spark: SparkSession, rows: Sequence[tuple[str, float, float]] = STATIONS) -> DataFrame:
    return dimension(spark, rows, "station string, lat double, lon double")
