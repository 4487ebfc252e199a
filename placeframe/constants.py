"""Fixed values.

Everything in this module must keep these exact values for results to agree
with the workload being reproduced (labels, thresholds, field names, sizes).
"""

# --- fixed values -----------------------------------------------------------
# climate_zone ladder on the trailing-window mean of the daily maximum (°F):
# first matching band wins; a non-null value below every band is "cold";
# a null value is "unknown".
CLIMATE_BANDS = ((80, "hot"), (60, "moderate"), (40, "cool"))
CLIMATE_BELOW = "cold"
CLIMATE_MISSING = "unknown"

# brewery_category buckets over the normalised brewery_type; anything else
# (null included) is "other".
CATEGORY_RULES = (
    (("micro", "nano", "brewpub"), "craft"),
    (("regional", "large"), "commercial"),
    (("taproom",), "taproom"),
)
CATEGORY_DEFAULT = "other"
ACCEPTED_CATEGORIES = ("craft", "commercial", "taproom", "other")

# location records kept by the country filter (null country is kept too)
COUNTRY_KEPT = "United States"

# daily weather fields, in request order, and the mean column each becomes
DAILY_FIELDS = (
    "temperature_2m_max",
    "temperature_2m_min",
    "precipitation_sum",
    "windspeed_10m_max",
)
MEAN_COLUMNS = (
    "avg_temp_max_f",
    "avg_temp_min_f",
    "avg_precipitation_inch",
    "avg_windspeed_mph",
)
SUMMARY_COLUMNS = (
    "state_avg_temp_max_f",
    "state_avg_temp_min_f",
    "state_avg_precipitation",
    "state_avg_windspeed",
)

# trailing window: [as_of - 7 days, as_of], both ends inclusive (8 dates)
WINDOW_DAYS = 7

# state_code = first two characters, upper-cased
STATE_CODE_LENGTH = 2

# page size of the paged location feed
PAGE_SIZE = 200

# number of rows shown by the preview
PREVIEW_ROWS = 10

# white space of every kind, as text stripping removes it
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# data tests of the models: (model, column) and accepted values
NOT_NULL_TESTS = (
    ("stg_locations", "brewery_id"),
    ("stg_locations", "brewery_name"),
    ("stg_locations", "state"),
    ("stg_locations", "brewery_type"),
    ("state_weather_summary", "state"),
    ("dim_locations", "brewery_id"),
    ("dim_locations", "brewery_category"),
    ("fact_location_weather", "brewery_id"),
    ("fact_location_weather", "state"),
)
UNIQUE_TESTS = (("stg_locations", "brewery_id"), ("dim_locations", "brewery_id"))
ACCEPTED_TESTS = (("dim_locations", "brewery_category", ACCEPTED_CATEGORIES),)
PREVIEW_COLUMNS = ("brewery_id", "name", "state", "brewery_type", "avg_temp_max_f", "climate_zone")
PREVIEW_ORDER = ("name", "state", "brewery_id")

# number of groups in the top-k report
TOP_K = 10
# ---------------------------------------------------------------------------
