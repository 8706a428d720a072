"""Labels, limits and formats that results depend on. Plain data, no logic."""

# --- fixed values: code labels of the dimension tables -------------------------------------------
VENDOR_DIM_LABELS = {
    1: "Creative Mobile Technologies, LLC",
    2: "VeriFone Inc.",
}
VENDOR_DIM_DEFAULT = "Unknown"

PAYMENT_DIM_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_DIM_DEFAULT = "Not specified"

RATE_CODE_LABELS = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
RATE_CODE_DEFAULT = "Unknown"

# --- fixed values: code labels of the gold tables (they differ from the dimensions') --------------
VENDOR_GOLD_LABELS = {
    1: "Creative Mobile Technologies",
    2: "VeriFone",
}
VENDOR_GOLD_DEFAULT = "Unknown"

PAYMENT_GOLD_LABELS = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided",
}
PAYMENT_GOLD_DEFAULT = "Other"

# --- fixed values: weekdays, Sunday = 1 ----------------------------------------------------------
DAY_NAMES = {
    1: "Sunday",
    2: "Monday",
    3: "Tuesday",
    4: "Wednesday",
    5: "Thursday",
    6: "Friday",
    7: "Saturday",
}
WEEKEND_DAYS = (1, 7)
DISPLAY_DAY_ORDER = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# --- fixed values: hour ranges, both ends inclusive ----------------------------------------------
TIME_PERIODS = {"Night": (0, 5), "Morning": (6, 11), "Afternoon": (12, 17)}
TIME_PERIOD_DEFAULT = "Evening"
RUSH_HOURS = ((7, 9), (17, 19))
PEAK_CATEGORIES = {"Morning Peak": (6, 10), "Evening Peak": (16, 20), "Midday": (11, 15)}
PEAK_CATEGORY_DEFAULT = "Off-Peak"

# --- fixed values: distance bands, upper bound exclusive -----------------------------------------
DISTANCE_BANDS = (
    ("0-1 miles", 1.0),
    ("1-2 miles", 2.0),
    ("2-5 miles", 5.0),
    ("5-10 miles", 10.0),
    ("10-20 miles", 20.0),
)
DISTANCE_BAND_LAST = "20+ miles"

# --- fixed values: limits -----------------------------------------------------------------------
MAX_PASSENGERS = 9
MAX_SPEED_MPH = 100
FISCAL_YEAR_FIRST_MONTH = 7
CALENDAR_START = "2009-01-01"
CALENDAR_END = "2030-12-31"
MIN_VALID_TRIPS = 100
MIN_AVG_REVENUE = 5
MAX_AVG_REVENUE = 200
MONTHS_SHOWN = 120
DAYS_SHOWN = 365
ZONES_SHOWN = 300
TOP_ZONES = 20
TIP_MONTHS = 12
HISTORY_DAYS = 90
BAND_LOW = 0.85
BAND_HIGH = 1.15
MAPE_GOOD = 10
MAPE_FAIR = 20
HORIZON_RANGE = (7, 365)
TRAINING_YEARS_RANGE = (1, 10)
TARGET_METRICS = ("total_trips", "total_revenue", "avg_trip_revenue")
FX_BASE = "EUR"

# --- fixed values: raw column, staged column, type ------------------------------------------------
STAGING_COLUMNS = (
    ("VendorID", "vendor_id", "bigint"),
    ("tpep_pickup_datetime", "pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "passenger_count", "bigint"),
    ("trip_distance", "trip_distance_miles", "double"),
    ("PULocationID", "pickup_location_id", "bigint"),
    ("DOLocationID", "dropoff_location_id", "bigint"),
    ("RatecodeID", "rate_code_id", "bigint"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("payment_type", "payment_type_id", "bigint"),
    ("fare_amount", "fare_amount", "double"),
    ("extra", "extra_charges", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("Airport_fee", "airport_fee", "double"),
)

# --- names of our own ----------------------------------------------------------------------------------

#: A raw row's place: fingerprint of its file's path, and its number in the file.
SOURCE_COLUMNS = ("_source_file", "_source_row")
