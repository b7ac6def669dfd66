"""Fixed values of the archive layout.

FIXED VALUES — these must equal the archive's published conventions for the
results (file names, chunk contents, level sets) to be right.  They are
stated plainly, in their natural order, in one place.  Large lists (the
262 single-level variable names) are *not* kept here: they are a parameter
(a DataFrame of variable names) to every operator that needs them.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Pressure-level groups (hPa).
PRESSURE_LEVEL_GROUPS = {
    "weatherbench_13": (50, 100, 150, 200, 250, 300, 400, 500, 600, 700, 850, 925, 1000),
    "full_37": (1, 2, 3, 5, 7, 10, 20, 30, 50, 70, 100, 125, 150, 175, 200, 225,
                250, 300, 350, 400, 450, 500, 550, 600, 650, 700, 750, 775, 800,
                825, 850, 875, 900, 925, 950, 975, 1000),
}

# A chunk "a_b_c" was split into one file per level type and short name:
#   <...>_hres_a.grb2_b_c.grib
SPLIT_SUFFIX = ".grib"

# Static surface geopotential is stored under a different name than its file.
VARIABLE_TO_FILE_NAME = {"geopotential_at_surface": "geopotential"}

# Dimensions dropped by the normalising scan of one raw block.
DROPPED_RAW_DIMS = ("number", "step", "pressure_level", "surface", "expver")

# Attribute keys removed from every variable's attribute map.
REMOVED_ATTRS = ("GRIB_cfName", "GRIB_cfVarName", "GRIB_shortName")

# Release codes.
RELEASE_FINAL = 1
RELEASE_PRELIMINARY = 5

# Chunks of the grouped archive.
MODEL_LEVEL_CHUNKS = ("dve", "tw", "o3q", "qrqs")
SINGLE_LEVEL_CHUNKS = (
    "cape", "cisst", "sfc", "tcol", "soil_depthBelowLandLayer_istl1",
    "soil_depthBelowLandLayer_istl2", "soil_depthBelowLandLayer_istl3",
    "soil_depthBelowLandLayer_istl4", "soil_depthBelowLandLayer_stl1",
    "soil_depthBelowLandLayer_stl2", "soil_depthBelowLandLayer_stl3",
    "soil_depthBelowLandLayer_stl4", "soil_depthBelowLandLayer_swvl1",
    "soil_depthBelowLandLayer_swvl2", "soil_depthBelowLandLayer_swvl3",
    "soil_depthBelowLandLayer_swvl4", "soil_surface_tsn", "lnsp",
    "zs", "rad", "pcp_surface_cp", "pcp_surface_crr",
    "pcp_surface_csf", "pcp_surface_csfr", "pcp_surface_es",
    "pcp_surface_lsf", "pcp_surface_lsp", "pcp_surface_lspf",
    "pcp_surface_lsrr", "pcp_surface_lssfr", "pcp_surface_ptype",
    "pcp_surface_rsn", "pcp_surface_sd", "pcp_surface_sf",
    "pcp_surface_smlt", "pcp_surface_tp")

# Short names held by each chunk.
CHUNK_VARIABLES = {
    "dve": ["d", "vo"],
    "tw": ["t", "w"],
    "o3q": ["q", "o3", "clwc", "ciwc", "cc"],
    "qrqs": ["crwc", "cswc"],
    "lnsp": ["lnsp"],
    "zs": ["z"],
    "cape": ["cape", "p79.162", "p80.162"],
    "cisst": ["siconc", "sst", "skt"],
    "sfc": ["z", "sp", "tcwv", "msl", "tcc", "u10", "v10", "t2m",
            "d2m", "lcc", "mcc", "hcc", "u100", "v100"],
    "tcol": ["tclw", "tciw", "tcw", "tcwv", "tcrw", "tcsw"],
    "soil_depthBelowLandLayer_istl1": ["istl1"],
    "soil_depthBelowLandLayer_istl2": ["istl2"],
    "soil_depthBelowLandLayer_istl3": ["istl3"],
    "soil_depthBelowLandLayer_istl4": ["istl4"],
    "soil_depthBelowLandLayer_stl1": ["stl1"],
    "soil_depthBelowLandLayer_stl2": ["stl2"],
    "soil_depthBelowLandLayer_stl3": ["stl3"],
    "soil_depthBelowLandLayer_stl4": ["stl4"],
    "soil_depthBelowLandLayer_swvl1": ["swvl1"],
    "soil_depthBelowLandLayer_swvl2": ["swvl2"],
    "soil_depthBelowLandLayer_swvl3": ["swvl3"],
    "soil_depthBelowLandLayer_swvl4": ["swvl4"],
    "soil_surface_tsn": ["tsn"],
    "rad": ["ssrd", "strd", "str", "ttr", "gwd"],
    "pcp_surface_cp": ["cp"],
    "pcp_surface_crr": ["crr"],
    "pcp_surface_csf": ["csf"],
    "pcp_surface_csfr": ["csfr"],
    "pcp_surface_es": ["es"],
    "pcp_surface_lsf": ["lsf"],
    "pcp_surface_lsp": ["lsp"],
    "pcp_surface_lspf": ["lspf"],
    "pcp_surface_lsrr": ["lsrr"],
    "pcp_surface_lssfr": ["lssfr"],
    "pcp_surface_ptype": ["ptype"],
    "pcp_surface_rsn": ["rsn"],
    "pcp_surface_sd": ["sd"],
    "pcp_surface_sf": ["sf"],
    "pcp_surface_smlt": ["smlt"],
    "pcp_surface_tp": ["tp"],
}

# Stores of the grouped archive and the chunks each one is built from.
STORE_CHUNKS = {
    "model-level-moisture": ["o3q", "qrqs"],
    "model-level-wind": ["dve", "tw"],
    "single-level-forecast": ["rad", "pcp_surface_cp", "pcp_surface_crr",
                              "pcp_surface_csf", "pcp_surface_csfr", "pcp_surface_es",
                              "pcp_surface_lsf", "pcp_surface_lsp", "pcp_surface_lspf",
                              "pcp_surface_lsrr", "pcp_surface_lssfr",
                              "pcp_surface_ptype", "pcp_surface_rsn", "pcp_surface_sd",
                              "pcp_surface_sf", "pcp_surface_smlt", "pcp_surface_tp"],
    "single-level-reanalysis": ["cape", "cisst", "sfc", "tcol",
                                "soil_depthBelowLandLayer_istl1",
                                "soil_depthBelowLandLayer_istl2",
                                "soil_depthBelowLandLayer_istl3",
                                "soil_depthBelowLandLayer_istl4",
                                "soil_depthBelowLandLayer_stl1",
                                "soil_depthBelowLandLayer_stl2",
                                "soil_depthBelowLandLayer_stl3",
                                "soil_depthBelowLandLayer_stl4",
                                "soil_depthBelowLandLayer_swvl1",
                                "soil_depthBelowLandLayer_swvl2",
                                "soil_depthBelowLandLayer_swvl3",
                                "soil_depthBelowLandLayer_swvl4",
                                "soil_surface_tsn"],
    "single-level-surface": ["lnsp", "zs"],
}

# Raw-archive consistency check: names expected per year.
CHECK_DAILY_CHUNKS = ("dve", "o3q", "qrqs", "tw", "tuvw")
CHECK_MONTHLY_CHUNKS = ("cape", "cisst", "lnsp", "pcp", "rad", "sfc", "soil", "tcol", "zs")
CHECK_MONTHLY_PCP = ("cp", "crr", "csf", "csfr", "es", "lsf", "lsp", "lspf",
                     "lsrr", "lssfr", "ptype", "rsn", "sd", "sf", "smlt", "tp")
CHECK_MONTHLY_SOIL = ("istl1", "istl2", "istl3", "istl4", "stl1", "stl2",
                      "stl3", "stl4", "swvl1", "swvl2", "swvl3", "swvl4")
CHECK_SOIL_SURFACE = "soil.grb2_surface_tsn.grib"

# Short -> long names of the native-vertical store.
SHORT_TO_LONG = {
    "cc": "fraction_of_cloud_cover",
    "ciwc": "specific_cloud_ice_water_content",
    "clwc": "specific_cloud_liquid_water_content",
    "crwc": "specific_rain_water_content",
    "cswc": "specific_snow_water_content",
    "d": "divergence",
    "o3": "ozone_mass_mixing_ratio",
    "q": "specific_humidity",
    "t": "temperature",
    "vo": "vorticity",
    "w": "vertical_velocity",
    "u": "u_component_of_wind",
    "v": "v_component_of_wind",
    "z": "geopotential",
}

# Store time axes: hourly analysis; forecasts twice a day (06, 18 UTC), 19 steps.
FORECAST_BASE_HOURS = (6, 18)
FORECAST_STEPS = 19
VALID_TIME_START = "1940-01-01"

# Processing modes.
MODE_FINAL = "era5"
MODE_DAILY = "daily"
MODE_MONTHLY = "monthly"

# Hodograph pressure bins (hPa), bottom to top.
HODOGRAPH_BINS = (1050, 700, 500, 300, 200, 50)

# Physical constants (IFS values).
R_DRY = 287.0597          # J kg-1 K-1
R_VAP = 461.5250          # J kg-1 K-1
G0 = 9.80665              # m s-2
G_HEIGHT = 9.80625        # divisor used for geopotential height plots
EARTH_RADIUS = 6371229.0  # m
CP_DRY = 1004.709         # J kg-1 K-1
T_ZERO = 273.16           # K, triple point
ES_A1 = 611.21            # Pa
ES_A3_WATER, ES_A4_WATER = 17.502, 32.19
ES_A3_ICE, ES_A4_ICE = 22.587, -0.7
T_ICE = 250.16            # K, below: all ice
# ----------------------------------------------------------- end fixed values

EPSILON = R_DRY / R_VAP


def all_chunks() -> list[str]:
    return list(MODEL_LEVEL_CHUNKS) + list(SINGLE_LEVEL_CHUNKS)
