"""Fixed values. These must be exactly these texts for results to agree with existing data."""

# Personal data masks.
EMAIL_MASK_PATTERN = r"^([^@\s]{1,2})[^@\s]*(@.+)$"
PHONE_MASK_PATTERN = r"(01[0-9])[\s.\-]?(\d{3,4})[\s.\-]?(\d{4})"

# Cleansing step ids and their action names.
CLEANSING_ACTIONS = {
    "CLN-COM-001": "WHITESPACE_NORMALIZE",
    "CLN-VAL-001": "PHONE_FORMAT",
    "CLN-VAL-002": "DATETIME_FORMAT",
    "CLN-VAL-003": "CODE_MAPPING",
}
# Steps that are switched off by default.
DISABLED_STEPS = ("CLN-VAL-003",)

# Phone standard.
PHONE_SEPARATORS = r"[\s.\-]"
PHONE_DIGITS_PATTERN = r"^01[0-9][0-9]{7,8}$"
PHONE_HYPHEN_PATTERN = r"^01[0-9]-[0-9]{3,4}-[0-9]{4}$"
# Phone style -> (pattern that a rule must have, mark between the parts).
PHONE_STYLES = {"DIGITS": (PHONE_DIGITS_PATTERN, ""), "HYPHEN": (PHONE_HYPHEN_PATTERN, "-")}
# Every kind of space at either end.
OUTER_SPACE = r"^[\s\u00A0\u3000]+|[\s\u00A0\u3000]+$"

# Date and time texts that cleansing accepts, and the standard it writes.
CLEANSING_DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyy.MM.dd", "yyyyMMdd")
CLEANSING_TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy.MM.dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy/MM/dd HH:mm",
    "yyyyMMddHHmmss",
)
STANDARD_DATE = "yyyy-MM-dd"
STANDARD_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"

# Date and time texts that profiling accepts.
PROFILE_DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd HH:mm",
    "yyyy/MM/dd",
    "yyyy.MM.dd",
)
# Date format labels, first match wins.
DATE_FORMAT_LABELS = (
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?$", "yyyy-MM-dd HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}([.+-].*)?$", "yyyy-MM-ddTHH:mm:ss(+TZ)"),
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}$", "yyyy/MM/dd HH:mm"),
    (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"),
    (r"^\d{4}\.\d{2}\.\d{2}$", "yyyy.MM.dd"),
)
PROFILE_EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
# Placeholder texts and the reserved-code marker.
PLACEHOLDER_VALUES = ("UNKNOWN", "TBD", "-", "N/A", "NA", "NULL", "미분류", "기타", "ETC", "")
RESERVED_MARK = "999"

# Rule vocabulary.
RULE_TYPES = ("NULL_CHECK", "PATTERN_CHECK", "RANGE_CHECK", "ORDER_CHECK", "CODE_EXISTS", "DUPLICATE_CHECK")
ERROR_GRADES = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "REVIEW")
CLEANSABLE_TYPES = ("PATTERN_CHECK", "CODE_EXISTS")
BLOCKING_GRADES = ("CRITICAL", "HIGH")
ISOLATING_ACTIONS = ("BLOCK", "REVIEW")

# Reason texts.
REASONS = {
    "NULL_CHECK": "Column '{0}' contains NULL or empty values.",
    "PATTERN_CHECK": "Column '{0}' does not match pattern '{pattern}'.",
    "RANGE_CHECK": "Column '{0}' is out of range [{min_value}, {max_value}].",
    "ORDER_CHECK": "Order violation: '{0}' is later than '{1}'.",
    "CODE_EXISTS": "Value in '{0}' does not exist in CODE_MASTER (Group: {code_group}).",
    "DUPLICATE_CHECK": "Duplicate records found for columns: {columns}.",
}

# Mapping vocabulary.
ACTIVE_RULE_STATUSES = ("ACTIVE",)
APPROVED_REVIEW_STATUSES = ("APPROVED", "MODIFIED_APPROVED")
CONSTANT_SOURCE_COLUMNS = ("(SOURCE_SYSTEM)", "<SOURCE_SYSTEM>")
MATCHING_RULES = ("NAME_DOB_PHONE_EXACT", "PLCY_NO_EXACT")
DEFAULT_SOURCE_ZONE = "Asia/Seoul"
# Source system -> (input table, name in the code map).
SOURCE_SYSTEMS = {
    "INBOUND": ("inbound", "인바운드"),
    "OUTBOUND": ("outbound", "아웃바운드"),
    "SALESFORCE": ("salesforce", "세일즈포스"),
    "HOMEPAGE": ("homepage", "민원"),
    "CHATBOT": ("chatbot", "챗봇"),
    "PRODUCT_MASTER": ("product_master", "상품마스터"),
}
# Record key column of each source.
RECORD_KEYS = {
    "inbound": "consultation_id",
    "outbound": "CTI_ID",
    "salesforce": "Consultation_No__c",
    "homepage": "COMPLAINT_ID",
    "chatbot": "session_id",
}
