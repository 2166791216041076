"""Fixed values that must equal the reference's for results to match.

They are stated as plain data, in their natural order, in one place.
"""

# ---- fixed values -------------------------------------------------------------

# Label: a flight is delayed when its arrival delay exceeds this many minutes.
DELAY_THRESHOLD_MIN = 15

# Risk brackets on the delay probability: >= HIGH is high, >= MEDIUM is medium.
RISK_HIGH = 0.40
RISK_MEDIUM = 0.25

# (risk, big label, verdict) per bracket.
RISK_TEXT = {
    "high": ("high", "DELAYED", "High Delay Risk"),
    "medium": ("medium", "POSSIBLY DELAYED", "Moderate Risk — Monitor Flight"),
    "low": ("low", "ON TIME", "Low Risk"),
}

# Strict probability threshold of the tuned forest.
CONFIDENCE_THRESHOLD = 0.6

# Defaults when a lookup misses.
DEFAULT_WEATHER = {"tavg": 15.0, "prcp": 2.0, "wspd": 15.0, "pres": 1013.0}
DEFAULT_DEP_COORDS = (39.0, -98.0)
DEFAULT_ARR_COORDS = (41.9, -87.9)
DEFAULT_DELAY_RATE = 0.20
DEFAULT_AIRCRAFT_AGE = 12

# Route estimate: miles per degree, minutes per 8 miles, floor of 30 minutes,
# haul cuts at 800 and 1500 miles with the reference's labels verbatim.
MILES_PER_DEGREE = 69
MILES_PER_MINUTE = 8
MIN_DURATION_MIN = 30
HAUL_CUTS = (800, 1500)
HAUL_LABELS = ("Short Haul >1500Mi", "Medium Haul <3000Mi", "Long Haul <6000Mi")

# Airline key -> display text.
AIRLINE_DISPLAY = {
    "Alaska Airlines Inc.": "AS — Alaska Airlines",
    "Allegiant Air": "G4 — Allegiant Air",
    "American Airlines Inc.": "AA — American Airlines",
    "American Eagle Airlines Inc.": "MQ — American Eagle",
    "Delta Air Lines Inc": "DL — Delta Air Lines",
    "Endeavor Air": "9E — Endeavor Air",
    "Frontier Airlines Inc.": "F9 — Frontier Airlines",
    "Hawaiian Airlines Inc.": "HA — Hawaiian Airlines",
    "JetBlue Airways": "B6 — JetBlue Airways",
    "PSA Airlines": "OH — PSA Airlines",
    "Republic Airways": "YX — Republic Airways",
    "Skywest Airlines Inc.": "OO — SkyWest Airlines",
    "Southwest Airlines Co.": "WN — Southwest Airlines",
    "Spirit Air Lines": "NK — Spirit Air Lines",
    "United Air Lines Inc.": "UA — United Airlines",
}

# Ordered categories of the heatmap.
DAY_ORDER = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
TIME_ORDER = ["Morning", "Afternoon", "Evening", "Night"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Heatmap cell level: average below this many minutes is Low, else Medium
# (inferred from the shipped heatmap: 14.81 Low, 16.11 Medium).
DELAY_LEVEL_CUT = 15

# Dashboard parameters.
TEMP_RANGE = (-35, 45)
TEMP_MIN_COUNT = 40
WINSOR_Q = (0.02, 0.98)
PRCP_Q = 0.99
MAP_DISPLAY_CLIP = (-15, 45)
BUBBLE_BASE = 10
BUBBLE_SCALE = 0.8
SAMPLE_POINTS = 2000

# Regression target clip, and prediction clip at evaluation.
REG_TARGET_CLIP = (-30, 300)
REG_PRED_CLIP = (0, 300)

# Columns dropped before training because they carry the outcome.
LEAKAGE_COLUMNS = [
    "Arr_Delay", "Dep_Delay", "Dep_Delay_Tag", "Dep_Delay_Type", "Arr_Delay_Type",
    "Delay_Carrier", "Delay_Weather", "Delay_NAS", "Delay_Security", "Delay_LastAircraft",
]
UNUSED_COLUMNS = ["Tail_Number", "Dep_CityName", "Arr_CityName", "Manufacturer", "Model"]

# Constant fills per pipeline.
FILL_PHASE1 = {"tavg": 10.0, "prcp": 0.0, "wspd": 5.0, "pres": 1010.0, "Aicraft_age": 10}
FILL_PHASE2 = {"Dep_Delay": 0, "Arr_Delay": 0, "DepTime_label": "Unknown", "Distance_type": "Unknown"}
FILL_REGRESSOR = {"LATITUDE": 39.0, "LONGITUDE": -98.0, "Aicraft_age": 12, "Day_Of_Week": 1,
                  "Airline": "Unknown", "DepTime_label": "Unknown", "Distance_type": "Unknown"}

WEATHER_COLS = ["tavg", "prcp", "wspd", "pres"]
CATEGORICAL_COLS = ["Airline", "DepTime_label", "Distance_type"]
CANCEL_KEYS = ["FlightDate", "Airline", "Tail_Number"]

# Classifier feature vector, in order.
FEATURE_COLS = [
    "tavg", "prcp", "wspd", "pres", "LATITUDE", "LONGITUDE", "month", "day_of_week",
    "dep_airport_delay_avg", "arr_airport_delay_avg",
    "Airline_vec", "DepTime_label_vec", "Distance_type_vec",
]

MODEL_NAMES = {"gbt": "GBT (Spark MLlib)", "svm": "SVM (Spark MLlib)"}

SEED = 42
