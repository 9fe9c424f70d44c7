"""Fixed values that must equal the behaviour being reproduced.

Everything here is data, not logic: column names, marker strings, lists and defaults.
"""

# ---------------------------------------------------------------------------
# Raw export layout (21 columns, by position).
# ---------------------------------------------------------------------------
RAW_COLUMNS = [
    "date", "invoice_num", "name", "license_plate", "mileage", "vin",
    "manufacturer", "type", "first_registration", "address_company",
    "address_name", "address_street_house_number", "address_postal_code_city",
    "address_other", "item_id", "item_description", "is_total", "amount",
    "price", "total", "balance",
]
ADDRESS_COLUMNS = [
    "address_company", "address_name", "address_street_house_number",
    "address_postal_code_city", "address_other",
]
NUMERIC_COLUMNS = ["amount", "price", "total", "balance"]

# ---------------------------------------------------------------------------
# Source defaults.
# ---------------------------------------------------------------------------
RAW_FILE_SUFFIXES = [".TXT"]
RAW_ENCODING = "iso8859_15"
# ISO-8859-15 differs from ISO-8859-1 in exactly these eight byte positions
# (0xA4 0xA6 0xA8 0xB4 0xB8 0xBC 0xBD 0xBE), listed in byte order.
LATIN1_CHARS_REPLACED_BY_LATIN9 = "¤¦¨´¸¼½¾"
LATIN9_CHARS = "€ŠšŽžŒœŸ"
# Line normalisation: middle dot -> hyphen, semicolon -> slash, tab separates fields.
MIDDLE_DOT = "·"
FIELD_SEPARATOR = "\t"
CSV_SEPARATOR = ";"

# Strings read as missing: '' and ' ' plus the default NA list of the CSV reader.
NA_STRINGS = [
    "", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# Characters Python's str.strip() removes (str.isspace), as a regex character class body.
PY_WHITESPACE_CLASS = (
    "\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x85\\xA0\\u1680\\u2000-\\u200A"
    "\\u2028\\u2029\\u202F\\u205F\\u3000"
)
# The same characters, one by one.
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

DATE_FORMAT = "d.M.yyyy"            # day-first, one or two digit day and month
TOTAL_MARKER = "-SPLITTEN-"          # value of is_total on invoice total rows
NAME_SEPARATOR = " - "               # "<customer number> - <description>"
WALK_IN_CUSTOMER = "10"              # counter sales account
PLATE_HASH_CHARS = 16
VIN_HASH_CHARS = 20

# ---------------------------------------------------------------------------
# Address repair and match-key normalisation.
# ---------------------------------------------------------------------------
POSTAL_CODE_PATTERN = r"^[0-9]{5} "
STREET_PATTERN = r".*[0-9]{1,4}([\s]{0,1})[a-zA-Z]?[\s]?$"
REPAIR_COMPANY_PLACEHOLDER = "Firma"
# Removed from the lower-cased key anywhere, in this order.
KEY_SALUTATIONS = ["herr ", "frau ", "herrn "]
SIMILARITY_CUTOFF = 90               # ratio >= 90 links two customers

# ---------------------------------------------------------------------------
# RFM features.
# ---------------------------------------------------------------------------
EXCLUDED_ITEM_IDS = ["11109", "11110", "11111", "11200", "33333", "S33333"]
DEFAULT_LOOKBACK_YEARS = 5
RFM_FEATURES = ["recency", "frequency", "monetary"]

# ---------------------------------------------------------------------------
# Training defaults.
# ---------------------------------------------------------------------------
N_QUANTILES = 50
BOUNDS_THRESHOLD = 1e-7
IQR_FACTOR = 1.5
KMEANS_K = 4
KMEANS_MAX_ITER = 300
KMEANS_TOL = 1e-4
KMEANS_SWEEP = list(range(1, 15))
# Cluster ordering: True = ascending, False = descending.
CLUSTER_FEATURE_SORT = {"recency": False, "frequency": True, "monetary": True}
KNN_TEST_SIZE = 0.3
KNN_SEED = 512
KNN_FOLDS = 4
KNN_K_RANGE = list(range(1, 49, 2))
KNN_WEIGHTS = "distance"

# Labelled rows that are broadcast at most (own parameter; more are joined).
KNN_MAX_POINTS = 200_000
# Certified error of the Euclidean silhouette (own parameter).
SILHOUETTE_TOLERANCE = 0.01

# Segment tiers (declared by the source project, not used by its pipeline).
RFM_TIERS_PER_FEATURE = {"recency": 4, "frequency": 4, "monetary": 4}
RFM_SCORE_SEGMENT_GT = {"low": 0, "medium": 3, "high": 6, "top": 8}
