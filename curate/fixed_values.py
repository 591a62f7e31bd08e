"""Values that must stay exactly as given for results to agree.

Nothing here is logic: header names, formats, limits, rule texts, word lists
and sentence templates, each in its natural order.
"""

# --- Fixed values: raw header text and the clean name of each column ---
ATTENDANCE_HEADERS = {
    "Fileno&1# CONFIDENTIAL": "fileno",
    "Applicant&2# PII": "applicant",
    "Age": "age_raw",
    "Branch": "branch",
    "Course Name": "course_name",
    "Course Date": "course_date_raw",
    "Number of Days": "number_of_days",
    "Number of Days Attended": "days_attended",
    "Number of Days Absent": "days_absent",
}
HEADER_TAG_PATTERN = r"&\d+#\s*(.*)$"

# --- Fixed values: date formats in order of preference, serial-day rule ---
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd")
SERIAL_DAY_PATTERN = "^[0-9]{4,6}$"
SERIAL_DAY_EPOCH = "1899-12-30"

# --- Fixed values: accepted age range, attendance bands ---
AGE_MIN = 16
AGE_MAX = 100
BAND_CUTS = (("High", 0.90), ("Medium", 0.60))
BAND_BELOW = "Low"
BAND_UNKNOWN = "Unknown"
RATE_SCALE = 4

# --- Fixed values: table columns in order ---
SILVER_COLUMNS = (
    "fileno", "applicant", "age_raw", "age_clean", "is_age_valid", "branch",
    "course_name", "course_date", "number_of_days", "days_attended",
    "days_absent", "dq_days_mismatch",
)
REJECT_COLUMNS = (
    "fileno", "applicant", "age_raw", "branch", "course_name",
    "course_date_raw", "number_of_days", "days_attended", "days_absent",
)
REJECT_REASON = "unparseable_course_date"

# --- Fixed values: quality rules (name, severity, applicable, passes, note) ---
ALL_DAYS_PRESENT = (
    "number_of_days IS NOT NULL AND days_attended IS NOT NULL AND days_absent IS NOT NULL"
)
ROW_RULES = (
    ("days_numeric_cast", "warn", "TRUE", ALL_DAYS_PRESENT,
     "TRY_CAST of Number of Days / Attended / Absent to INT"),
    ("course_date_parseable", "blocking", "TRUE", "course_date IS NOT NULL",
     "Parses ISO / dd-MM-yyyy / yyyy-MM-dd / Excel serial; failures quarantined"),
    ("age_in_range_16_100", "warn", "age_raw IS NOT NULL AND TRIM(age_raw) <> ''", "is_age_valid",
     "Non-numeric or out-of-range age nulled, row retained"),
    ("days_reconcile", "warn", ALL_DAYS_PRESENT,
     "CAST(days_attended AS BIGINT) + days_absent = number_of_days",
     "Day-count reconciliation; flagged via dq_days_mismatch"),
)
EXACT_RULE = ("exact_duplicate_rows", "warn", "SELECT DISTINCT collapse of byte-identical rows")
MALFORMED_RULE = ("well_formed_record", "blocking",
                  "Lines of too many or too few fields or a torn quote; quarantined whole")
KEY_RULE = ("duplicate_fileno_conflict", "warn",
            "Conflicting records per Fileno; latest course_date wins")
ALERT_FLOOR = 0.90
ALERT_WINDOW_DAYS = 1

# --- Fixed values: document sentences ---
DOCUMENT_TEXT = (
    "Attendance record {name}: a participant {age_txt} was enrolled in the "
    "'{course_name}' course at the {branch} branch, starting {course_date}. "
    "The course was scheduled for {scheduled} days; the participant attended "
    "{attended} days and was absent {absent} days, giving a "
    "record-level attendance rate of {rate_txt}. {band_txt}"
)
DOCUMENT_TYPE = "attendance record"
AGE_KNOWN = "aged {age}"
AGE_UNKNOWN = "with no validated age on record"
DATE_UNKNOWN = "an unrecorded date"
RATE_UNKNOWN = "not computable (missing day counts)"
BAND_KNOWN_TEXT = "This record is classified in the {attendance_band} attendance band."
BAND_UNKNOWN_TEXT = "This record has no attendance band classification."
VALUE_UNKNOWN = "unknown"

# --- Fixed values: answers ---
REFUSAL = "I don't have enough information in the curated data to answer that question."
SIMILARITY_THRESHOLD = 0.49
DEFAULT_K = 3
LOWEST_WORDS = ("lowest", "worst", "minimum", "least")
HIGHEST_WORDS = ("highest", "best", "maximum", "most")
LOWEST_BODY = "{name} has the lowest attendance rate at {rate_txt}."
HIGHEST_BODY = "{name} has the highest attendance rate at {rate_txt}."
LOOKUP_BODY = "{name} — {course_name} at {branch}: attendance rate {rate_txt}."
LOOKUP_RATE_UNKNOWN = "not computable"
CITATION = "[{type}: {name} — {course_name} @ {branch} — {rate_txt} ({attended}/{scheduled} days)]"
CITATION_RATE_UNKNOWN = "n/a"

# --- Fixed values: question texts, hits to use (None: all), whether records answer them ---
COURSE_QUESTIONS = (
    ("What is the attendance rate for the {} course?", 3, True),
    ("How many days did the {} participant attend?", 3, True),
    ("Which {} attendance record has the lowest attendance rate?", 3, True),
    ("Which {} attendance record has the highest attendance rate?", 3, True),
)
BRANCH_QUESTIONS = (("What courses are running in {}?", 3, False),)
GENERAL_QUESTIONS = (
    ("Which attendance record has the lowest attendance rate?", None, True),
    ("Which attendance record has the highest attendance rate?", None, True),
    ("Average age of participants?", 3, False),
    ("What is the annual leave entitlement?", 3, False),
)

# --- Fixed values: masking ---
MASK_TEXT = "***REDACTED***"
LAYERS = ("bronze", "silver", "gold", "governance")
