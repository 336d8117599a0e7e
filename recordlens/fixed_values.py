"""Fixed values.

Every constant here has to equal the published rules for results to come out right, so
they are stated plainly and together. Nothing is computed but patterns put together from lists.
"""

# --- recency, thresholds, limits -------------------------------------------------
RECENCY_MONTHS = 18
MIN_RECORDS_TOP = 5
MIN_RECORDS_BOTTOM = 3
RANKING_ROWS = 10
AUDIT_ROWS = 20
MIN_SHARED_EVENTS = 2
HANDOFF_MIN_GAP_DAYS = 150
TRIAGE_MIN_RECORDS = 3
TRIAGE_MAX_MEAN = 85
COVERAGE_LOW_PCT = 90
COVERAGE_HIGH_PCT = 110
SYSTEMATIC_MEDIAN_PCT = 95
SYSTEMATIC_MIN_WEEKS = 10
OVERLAP_NOT_BEFORE = "2025-02-01"
FETCH_WINDOW_DAYS = 2
FETCH_PAGE_ROWS = 25
FETCH_RESULT_CAP = 225
SPIRAL_STEP_METRES = 7
METRES_PER_DEGREE = 111320
COORDINATE_DECIMALS = 5
SEARCH_MIN_CHARS = 2
SEARCH_HITS = 8

# --- record vocabulary -----------------------------------------------------------
SCORED_TYPE = "2017 FDA Food Inspection"
FOOD_PROGRAM = "Food"
ROUTINE = "Routine"
FOLLOW_UP = "Follow-Up"
FOLLOW_UP_PROCESS = "Follow-Up Inspection"
BATCH_SOURCE = "socrata"
PORTAL_SOURCE = "portal"
ADMIN_FLAG_PATTERN = r"(?i)^OOB\b|INELIGIBLE"
COMMENT_MARKER = "CFM"

# --- score bands: key, label, colour, lowest and highest score -------------------
BANDS = (
    ("red", "69 & below", "#d62828", 0, 69),
    ("orange", "70–79", "#8e24aa", 70, 79),
    ("yellow", "80–89", "#1976d2", 80, 89),
    ("green", "90–100", "#2a9d3f", 90, 100),
)

# --- AP style months -------------------------------------------------------------
AP_MONTHS = (
    "Jan.", "Feb.", "March", "April", "May", "June",
    "July", "Aug.", "Sept.", "Oct.", "Nov.", "Dec.",
)

# --- cities, longest first, and the jurisdiction codes stamped onto names --------
CITIES = (
    "West Lake Hills", "Dripping Springs", "Travis County", "Marble Falls",
    "Sunset Valley", "Pflugerville", "Rollingwood", "Cedar Park", "Round Rock",
    "Briarcliff", "Creedmoor", "Bee Caves", "Spicewood", "Manchaca", "Del Valle",
    "Bee Cave", "Volente", "Lakeway", "Elgin", "Hutto", "Manor", "Austin",
)
CITY_SPELLING = {"Bee Caves": "Bee Cave"}
DEFAULT_CITY = "Austin"
STATE = "TX"
NAME_PREFIX_CITY = {
    "PF": "Pflugerville", "LW": "Lakeway", "BC": "Bee Cave", "MN": "Manor",
    "WL": "West Lake Hills", "SV": "Sunset Valley", "RW": "Rollingwood",
    "ABIA": "Austin", "COTA": "Austin",
}
DISPLAY_CITY_CODES = ("PF", "LW", "BC", "MN", "WL", "SV", "RW")
MATCH_PREFIXES = (
    "oob", "pf", "lw", "bc", "mn", "wl", "sv", "rw", "abia", "cota", "tc", "rr", "heb",
)

# --- street vocabulary -----------------------------------------------------------
KEEP_UPPER = (
    "NB", "SB", "EB", "WB", "NE", "NW", "SE", "SW",
    "IH", "FM", "SH", "US", "RR", "RM", "CR", "TX",
)
ROAD_DESIGNATORS = ("IH", "FM", "SH", "US", "RR")
BOUND_SUFFIXES = ("NB", "SB", "EB", "WB")
UNIT_WORDS_GEOCODE = (
    "Ste", "Suite", "Unit", "Bldg", "Building", "Apt", "Rm", "Room",
    "Fl", "Floor", "Lot", "Space", "Spc",
)
UNIT_WORDS_MATCH = (
    "suite", "ste", "unit", "bunit", "bldg", "building", "apt", "rm", "room", "fl", "floor",
)
# Patterns and replacements of the address rules, applied in order.
FULL_CITY_TAIL = r"(?i),\s*[A-Za-z .]+,\s*TX,?\s*[0-9]{5}(-[0-9]{4})?(\s+[A-Za-z .]+)?$"
HIDDEN_ZIP = r"\b(7[0-9]{4})\b"
SHOWN_UNIT_RULES = (
    (r"(?i)#?\s*\bBunit\b", " Unit"),
    (r"(?i)\bUnit\s*#\s*", "Unit "),
    (r"(?i)\s*#?\s*\bUnit\s*$", ""),
    (r"#\s*#", "#"),
    (r"\s*#\s*$", ""),
)
GEOCODE_STREET_RULES = (
    (r"(?i)\s+B?unit\b.*$", ""),
    (rf"(?i)\s+({'|'.join(UNIT_WORDS_GEOCODE)})\.?\s*[A-Za-z0-9&/-]*\.?$", ""),
    (r"\s+#\s*[A-Za-z0-9&/-]+$", ""),
    (r"(?i)\bSVRD\b", "Service Rd"),
    (rf"(?i)\s+\b({'|'.join(BOUND_SUFFIXES)})\b", ""),
    (r"(?i)\bIH\s*-?\s*([0-9]+)", "I-$1"),
    (r"(?i)\bHwy\b", "Highway"),
    (r"(?i)\bFM\s*-?\s*([0-9]+)", "FM $1"),
)
VENUE_SUFFIX_WORDS = (r"#", r"No\.?", "Unit", "Stand", "Store")

# --- establishment categories, in dictionary order -------------------------------
RESTAURANT = "Restaurant & Food Service"
SCHOOL = "School & Childcare"
CONVENIENCE = "Convenience & Fuel"
GROCERY = "Grocery"
HEALTHCARE = "Healthcare"
VENUE = "Venue & Concessions"
INSTITUTIONAL = "Institutional & Catering"
RETAIL = "Retail & Specialty"
CATEGORIES = (
    RESTAURANT, SCHOOL, CONVENIENCE, GROCERY, HEALTHCARE, VENUE, INSTITUTIONAL, RETAIL,
)

# Exact names no pattern can reach.
NAME_OVERRIDES = {
    "Growing Imaginations L.C.": SCHOOL,
    "Westgate II": RETAIL,
}

# Patterns are tried top to bottom on the lower-cased name; the first hit decides.
CATEGORY_RULES = (
    (RESTAURANT, ("mandola",)),
    (HEALTHCARE, (
        "hospital", "medical cent", r"\bclinic\b", "healthcare", r"\bseton\b", "dell children",
    )),
    (SCHOOL, (
        "school", "elementary", "middle sch", "high sch", r"\bh s$", r"\bisd\b",
        "academy", "montessori", "childcare", "child care", "early childhood",
        "kinder", "daycare", "day care", "learning cent", "learning experience",
        "early learning", "preschool", "pre-school", "prep school", "college prep",
        "head start", "nursery", "goddard", "primrose", "child development",
        "children'?s cent", "children'?s courtyard", r"\bcdc\b",
        r"\bkipp\b", "^idea ", "idea public", "harmony science", r"\bvalor\b",
        r"\bbasis\b", "university", "college", "dining hall",
    )),
    (HEALTHCARE, (
        "nursing", "rehab", "assisted living", "senior living", "memory care",
        "memory support", "hospital", "clinic", "medical cent", "health cent",
        "hospice", "care cent", r"\btreatment\b", "mother teresa", "marbridge",
    )),
    (INSTITUTIONAL, (
        "aramark", "sodexo", "compass group", "canteen", "cafeteria",
        "employee dining", "corporate dining", "break room", "micro market",
        "commissary", "catering", "caffe mac", r"^parmer lane \d", "@ samsung",
        "sorority", "fraternity", "delta gamma", r"\bpod$", "prep kitchen",
        "importing", "wholesale", "distribut", "roasting",
        r"\bshelter\b", "settlement home", "home for children",
        r"\bjail\b", "correctional", "gardner betts",
    )),
    (CONVENIENCE, (
        "7-eleven", "7 eleven", "foods? mart", r"\bmart\b", "xpress", r"\bcvs\b",
        "walgreen", r"\bpharmacy\b", "dollar gen", "dollar tree", "family dollar",
        "circle k", r"\bexxon\b", r"\bshell\b", r"\bvalero\b", "chevron",
        "conoco", "texaco", r"\bquik", "corner store", "convenience", "gas station",
    )),
    (GROCERY, (
        "h-e-b", r"\bheb\b", "randall'?s", "wal-?mart", r"\btarget\b", "costco",
        "sam'?s club", "sprouts", "whole foods", "trader joe", "fiesta mart",
        "supermercado", "supermarket", "grocery", r"\bmarket",
    )),
    (VENUE, (
        "^levy ", "levy at", "q2 stadium", "^cota", "^abia", "circuit of the am",
        "moody cent", "erwin cent", r"\bstadium\b", r"\barena\b", "amphitheat",
        "concession", "suite pantry", "club level", "hawking", "grand stand",
        "campsite", "waterpark", "water park", "quarries",
    )),
    (RETAIL, (
        "candy", r"\bgift", "general store", "oils? & vinegar", "total wine",
        "wine & spirits", r"\bliquor\b", "serasana", r"\bfeed\b", "florist",
    )),
)

# --- older three-band colouring: lowest, highest, group, label, colour -----------
THREE_BANDS = (
    (None, 69, "Red", "Red: 69 and below", "red"),
    (70, 85, "Yellow", "Yellow: 70 to 85", "gold"),
    (86, 100, "Green", "Green: 86 to 100", "green"),
)
THREE_BANDS_MISSING = (None, "Missing score", "gray")

# --- portal record columns -------------------------------------------------------
PORTAL_COLUMNS = (
    "inspectionID", "permitID", "inspectionDate", "score", "inspectionType",
    "programName", "purpose", "comments", "TimeIn", "establishmentName",
    "addressLine1", "addressLine2", "city", "state", "zip", "permitType",
)
MAP_FIELDS = ("n", "a", "c", "z", "y", "x", "s", "d", "f", "k", "q", "u")
MATCH_TIERS = (
    ("name+street+zip", ("k_name", "k_street", "zip")),
    ("name+num+zip", ("k_name", "k_num", "zip")),
)
