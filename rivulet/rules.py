"""Rule constants.

Three rule sets exist side by side and must not be merged:

* BIS thresholds       - used while cleaning extracted samples,
* Class-A limits       - used for the 0-10 score, labels and violation lists,
* display limits       - used by parameter statistics and comparisons.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Limits, weights, caps, labels, word lists and sentences. They define the results.
# --------------------------------------------------------------------------

BIS_DO_MIN = 5.0
BIS_PH_MIN = 6.5
BIS_PH_MAX = 8.5
BIS_BOD_MAX = 3.0
BIS_FECAL_MAX = 500.0
BIS_TOTAL_MAX = 2500.0
# Points of the 0-100 score at the limit.
BIS_BOD_FACTOR = 33.3
BIS_COLIFORM_FACTOR = 10

OUTLIER_CAPS = {
    "bod_avg": 500.0,
    "fecal_coliform_avg": 1_000_000.0,
    "total_coliform_avg": 5_000_000.0,
    "conductivity_avg": 50_000.0,
    "nitrate_avg": 100.0,
}

CLASS_A_PH_MIN = 6.5
CLASS_A_PH_MAX = 8.5
CLASS_A_DO_MIN = 6.0
CLASS_A_BOD_MAX = 2.0
CLASS_A_NITRATE_MAX = 10.0
CLASS_A_FECAL_MAX = 50.0

CLASS_A_WEIGHTS = {"ph": 0.10, "do": 0.20, "bod": 0.25, "nitrate": 0.15, "fecal": 0.30}
DOMINANT_SHARE = 0.6
WEIGHTED_SHARE = 0.4

# column, label, unit, limit, limit source (None: no limit is applied)
DISPLAY_PARAMETERS = [
    ("bod_avg", "BOD", "mg/L", 3.0, "CPCB"),
    ("do_avg", "DO", "mg/L", 5.0, "CPCB"),
    ("ph_avg", "pH", "", None, "BIS"),
    ("nitrate_avg", "Nitrate", "mg/L", 10.0, "WHO"),
    ("fecal_coliform_avg", "Fecal Coliform", "MPN/100ml", 500.0, "WHO"),
    ("conductivity_avg", "Conductivity", "µS/cm", None, ""),
]

COMPARE_PARAMETERS = [
    ("bod_avg", "BOD", "mg/L", 3.0),
    ("do_avg", "DO", "mg/L", 5.0),
    ("ph_avg", "pH", "", None),
    ("nitrate_avg", "Nitrate", "mg/L", 10.0),
    ("fecal_coliform_avg", "Fecal Coliform", "MPN/100ml", 500.0),
    ("pollution_score", "Pollution Score", "", None),
]

TREND_PARAMETERS = [
    "do_avg", "ph_avg", "bod_avg", "nitrate_avg", "fecal_coliform_avg",
    "conductivity_avg", "pollution_score",
]

# Relative change below which a trend counts as stable.
STABLE_SHARE = 0.05

# Cause and impact text per canonical parameter.
PARAMETER_KNOWLEDGE = {
    "BOD": (
        "High BOD indicates organic pollution due to sewage or industrial discharge.",
        "Reduces oxygen available for aquatic life.",
    ),
    "DO": (
        "Low dissolved oxygen indicates poor water quality.",
        "Harms aquatic organisms.",
    ),
    "Nitrate": (
        "High nitrate caused by agricultural runoff or fertilizers.",
        "Leads to eutrophication and health risks.",
    ),
    "Fecal Coliform": (
        "Indicates contamination from human or animal waste.",
        "Risk of waterborne diseases.",
    ),
    "pH": (
        "Abnormal pH due to chemical discharge.",
        "Affects aquatic life and water chemistry.",
    ),
}

FOLLOWUP_UNSAFE = [
    ("BOD", "What causes high BOD in rivers?"),
    ("Fecal Coliform", "What are the health effects of fecal coliform?"),
    ("Nitrate", "How does nitrate contamination affect health?"),
    ("DO", "What causes low dissolved oxygen?"),
    ("pH", "What causes abnormal pH in water?"),
]
FOLLOWUP_DEFAULT = [
    "What are the recommended treatment methods?",
    "Which WHO guidelines are being violated?",
    "How is pollution score calculated?",
]
FOLLOWUP_SAFE = [
    "What parameters should be monitored regularly?",
    "What are WHO guidelines for safe drinking water?",
    "How is pollution score calculated?",
]
FOLLOWUP_GENERAL = [
    "What is the safe limit for BOD?",
    "What causes low dissolved oxygen in rivers?",
    "How can water quality be improved?",
]

SUGGESTIONS_WITHOUT_VIOLATIONS = [
    ("Which parameters should be monitored regularly at this station?", "Monitoring guidance"),
    ("What are the WHO/BIS safe limits for common river parameters?", "Standards reference"),
    ("How is the pollution score calculated for this station?", "Methodology"),
]

STATION_QUESTION_KEYWORDS = [
    "this station", "the station", "station context", "this water", "these readings",
    "these levels", "this location", "analyse", "analyze", "monitoring location",
]
RISK_QUESTION_KEYWORDS = [
    "unsafe", "safe", "violation", "violations", "out of limit", "exceed", "high bod",
    "high nitrate", "high fecal", "contaminated", "polluted", "why is", "why unsafe",
    "health risk", "risk level", "water quality status",
]
NEEDS_STATION_KEYWORDS = [
    "this station", "the station", "why unsafe", "why is it", "why is this", "is it safe",
    "station context",
]

# Keys tried, in this order, when a reply item is an object.
REPLY_ITEM_KEYS = [
    "action", "risk", "cause", "recommendation", "explanation", "detail", "description",
    "note", "text",
]
FALLBACK_ANSWER = "Sorry, could not process request"

STATES = [
    "ANDHRA PRADESH", "ARUNACHAL PRADESH", "ASSAM", "BIHAR", "CHHATTISGARH", "GOA", "GUJARAT",
    "HARYANA", "HIMACHAL PRADESH", "JAMMU AND KASHMIR", "JHARKHAND", "KARNATAKA", "KERALA",
    "MADHYA PRADESH", "MAHARASHTRA", "MANIPUR", "MEGHALAYA", "MIZORAM", "NAGALAND", "ODISHA",
    "PUNJAB", "RAJASTHAN", "SIKKIM", "TAMIL NADU", "TELANGANA", "TRIPURA", "UTTAR PRADESH",
    "UTTARAKHAND", "WEST BENGAL", "ANDAMAN AND NICOBAR", "CHANDIGARH", "DADRA AND NAGAR HAVELI",
    "DAMAN AND DIU", "DELHI", "LAKSHADWEEP", "PUDUCHERRY", "LADAKH", "JAMMU & KASHMIR", "J&K",
    "J & K",
]

# A table row whose joined lower-case text contains one of these texts or patterns is a heading.
HEADING_TEXTS = [
    "primary water quality criteria", "monitoring location", "state name", "temperature",
    "dissolved oxygen",
]
HEADING_PATTERNS = [r"stn\s*code", r"min\s+max", r"^\s*$"]

# Page layout markers, upper case, in order of precedence.
COASTAL_HEADING = "TYPE WATER BODY"
GROUNDWATER_MARKERS = [
    "ARSENIC", "FLUORIDE", "TDS", "TOTAL DISSOLVED SOLIDS", "GROUND WATER", "GROUNDWATER",
    "BOREWELL",
]
COASTAL_MARKERS = ["MARINE", "SEA", "COASTAL", "BEACH", "CREEK"]
CANAL_MARKERS = ["CANAL", "CANALS", "IRRIGATION", "BARRAGE"]
DRAIN_MARKERS = ["DRAIN", "STP", "WTP", "SEWAGE", "EFFLUENT"]
RIVER_MARKERS = ["DISSOLVED OXYGEN", "WATER QUALITY", "RIVER", "BOD", "NITRATE"]
TYPE_COLUMN_FILE_HINT = "creek_marine"

# Water body by substring, first rule wins.
PAGE_TEXT_TYPES = [
    ("River", ["river"]),
    ("Canal", ["canal"]),
    ("Pond/Tank", ["pond", "tank"]),
    ("Coastal", ["marine", "sea", "coastal", "beach"]),
    ("Drain/STP/WTP", ["drain", "stp", "wtp"]),
]
FILE_NAME_TYPES = [
    ("River", ["river"]),
    ("Canal", ["canal"]),
    ("Pond/Tank", ["pond", "tank"]),
    ("Coastal", ["marine", "sea"]),
    ("Drain/STP/WTP", ["drain"]),
]
# Applied where the layout of a page is not known.
FALLBACK_FILE_TYPES = [
    ("Coastal", ["coastal", "beach"]),
    ("Groundwater", ["ground", "groundwater", "borewell"]),
    ("Drain/STP/WTP", ["stp", "wtp"]),
]

# Accepted report file names, {year} stands for the four digits of the year.
REPORT_FILE_PATTERNS = [
    r"WQuality_River-Data-{year}\.pdf",
    r"Water_Quality_data_of_Med_Min_River_{year}\.pdf",
    r"Water_creek_marine_seawater_beach_{year}\.pdf",
    r"Water_Quality_Canals_{year}\.pdf",
    r"Water_Quality_Drains_STPs_WTPs_{year}\.pdf",
    r"Water_pond_tanks_{year}\.pdf",
    r"NWMP_DATA_{year}\.pdf",
]

# Words removed from a station name before it is looked up in a gazetteer.
GEO_LEADING_WORDS = [
    "river", r"r\.", "rsvr", "reservoir", "lake", "canal", "drain", "nallah", "nala", "creek",
]
GEO_POSITION_WORDS = [
    "u/s", "d/s", "upstream", "downstream", "near", "at", "of", "before", "after", "confluence",
    "bridge", "barrage", "dam", "intake", "point", "jackwell", "water supply", "water works",
    "water", "pumping station", "road", "highway", "national highway", r"nh-?\d+", r"sh-?\d+",
    r"bdg\.?", r"brdg\.?",
]
GEO_DESCRIPTOR_WORDS = [
    "borewell", "school", "msw", "site", "college", "plant", "unit", "ward", "village", "layout",
    "area",
]
GEO_SPELLINGS = {"vammanjoor": "vamanjoor"}
COUNTRY = "India"

# Cell texts read as missing in CSV files.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

API_ROW_LIMIT = 1000
