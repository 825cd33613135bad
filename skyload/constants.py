"""Physical constants, limits and column lists that results depend on."""

# --- unit conversions -------------------------------------------------------
KNOT_IN_FT_PER_S = 1.6878098571012
METRE_IN_FT = 3.28084
SECONDS_PER_MINUTE = 60.0
GRAVITY_FT_PER_S2 = 32.17405

# --- international standard atmosphere --------------------------------------
ISA_SEA_LEVEL_K = 288.15
ISA_SEA_LEVEL_PA = 101325.0
ISA_GAS_CONSTANT = 287.05287
ISA_GRAVITY = 9.80665
ISA_LAPSE_PER_M = 0.0065
ISA_TROPOPAUSE = 11000.0
ALTITUDE_MIN = 0.0
ALTITUDE_MAX = 47000.0

# --- altitude smoothing ------------------------------------------------------
SMOOTHING_MAX_WINDOW = 21
SMOOTHING_MIN_WINDOW = 5

# --- flight phases -----------------------------------------------------------
TAKEOFF_END_QUANTILE = 0.1
TOP_OF_CLIMB_SHARE = 0.95
MANUAL_TAKEOFF_END_FT = 5000.0
MANUAL_TOP_OF_CLIMB_FT = 15000.0
REFINED_TAKEOFF_QUANTILE = 0.5
REFINED_CLIMB_QUANTILE = 0.25
REFINED_CLIMB_ALTITUDE_SHARE = 0.8

# --- segments ----------------------------------------------------------------
NARROW_BODY_LIMIT_KG = 115680
WIDE_BODY_TYPE = "B77W"
MTOW_SEGMENTS = ("very_low", "low", "medium", "high", "non_b77w", "b77w")
DISTANCE_SEGMENTS = ("0-500", "500-1000", "above_1000", "non_b77w", "b77w")
DISTANCE_EDGES = (0.0, 500.0, 1000.0)

# --- columns -----------------------------------------------------------------
KEY = "flight_id"
TARGET = "tow"
DATE_COLUMNS = ("date", "actual_offblock_time", "arrival_time")
DROPPED_FEATURES = (
    "date",
    "callsign",
    "name_adep",
    "name_ades",
    "actual_offblock_time",
    "arrival_time",
)
LABEL_COLUMNS = (
    "adep",
    "country_code_adep",
    "ades",
    "country_code_ades",
    "aircraft_type",
    "airline",
)
ONE_HOT_COLUMN = "wtc"
NOT_NORMALISED = (
    "flight_id",
    "tow",
    "date",
    "callsign",
    "adep",
    "ades",
    "actual_offblock_time",
    "arrival_time",
    "aircraft_type",
    "wtc",
    "airline",
)
