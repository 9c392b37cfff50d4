"""They must equal the published data contract for results to match."""

# Country of residence (upper case) -> ISO 3166 alpha-2 code.
ISO_CODE_BY_COUNTRY = {
    "UNITED KINGDOM": "GB",
    "UNITED STATES": "US",
    "FRANCE": "FR",
    "GERMANY": "DE",
    "SPAIN": "ES",
    "ITALY": "IT",
    "AUSTRALIA": "AU",
    "CANADA": "CA",
    "INDIA": "IN",
    "JAPAN": "JP",
    "BRAZIL": "BR",
    "NETHERLANDS": "NL",
    "SWEDEN": "SE",
    "NORWAY": "NO",
    "UAE": "AE",
    "SINGAPORE": "SG",
    "SOUTH AFRICA": "ZA",
    "THAILAND": "TH",
    "MEXICO": "MX",
    "IRELAND": "IE",
}
UNKNOWN_ISO_CODE = "UN"

# Destination (upper case) -> continent label.
CONTINENT_BY_DESTINATION = {
    "THAILAND": "Asia",
    "SPAIN": "Europe",
    "USA": "North America",
    "JAPAN": "Asia",
    "AUSTRALIA": "Oceania",
    "UAE": "Middle East",
    "FRANCE": "Europe",
    "ITALY": "Europe",
    "MALDIVES": "Asia",
    "UK": "Europe",
}
UNKNOWN_CONTINENT = "Other"

# Text that means true when raw flights are cleaned (compared in lower case).
CLEANING_TRUE_TEXT = ("true", "1", "yes")
# Text that means true when flights are standardised (compared as written).
STANDARD_TRUE_TEXT = ("true", "TRUE", "1")

# Public md5 surrogate-key convention: stand-in for NULL and separator.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"

# Enumerations of the source tables.
COVERAGE_TYPES = ("medical", "cancellation", "baggage", "comprehensive")
POLICY_STATUSES = ("active", "expired", "cancelled")
CLAIM_TYPES = ("medical", "cancellation", "baggage", "delay")
CLAIM_STATUSES = ("pending", "approved", "rejected")

# Calendar dimension bounds (both inclusive).
CALENDAR_START = "2023-01-01"
CALENDAR_END = "2025-12-31"

# Operating thresholds.
DEDUP_SECONDS = 30
WATERMARK_DEFAULT = "1900-01-01 00:00:00"
RECONCILE_THRESHOLD = 95.0
LAG_ALERT = 1000
LANDING_MINUTES = 30
GATE_HOURS = 24
WARN_HOURS = 24
ERROR_HOURS = 48
RECENT_POLICY_HOURS = 1
RECENT_POLICY_LIMIT = 200
POLICY_EVENT_TYPE = "policy_purchase"

# Source table -> BRONZE table of the batch extract.
EXTRACT_TARGETS = {
    "customers": "raw_customers",
    "policies": "raw_policies",
    "claims": "raw_claims",
}
