"""Fixed values that must equal the reference's for identical results.

Everything here is a domain constant (enum values, code lists, thresholds, word
lists). They are stated once, in natural order, and imported everywhere else.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: enum domains
# ---------------------------------------------------------------------------
PAYMENT_METHODS = ["credit_card", "debit_card", "ach", "wire", "digital_wallet"]
PAYMENT_STATUSES = ["pending", "authorized", "captured", "declined", "failed", "refunded", "cancelled"]
# statuses the silver CASE maps (pending / cancelled fall through to UNKNOWN)
NORMALIZED_STATUSES = ["authorized", "captured", "declined", "refunded", "failed"]
TRANSACTION_TYPES = ["charge", "refund", "dispute", "reversal"]
TRANSACTION_STATUSES = ["initiated", "processing", "completed", "failed", "abandoned"]
RISK_LEVELS = ["low", "medium", "high", "critical"]
ALERT_TYPES = [
    "velocity_exceeded", "amount_anomaly", "card_not_present_mismatch", "unusual_location",
    "device_fingerprint_mismatch", "bin_blacklist", "three_d_secure_failure", "velocity_by_card",
    "velocity_by_ip", "duplicate_transaction", "ml_prediction",
]
CASE_DECISIONS = ["approve", "decline", "review", "challenge", "block"]
CASE_STATUSES = ["pending", "under_review", "resolved", "escalated", "closed"]
DATA_CLASSIFICATIONS = ["public", "internal", "confidential", "pci_dss_restricted", "pii_restricted"]
VALID_CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CAD", "AUD"]

# ---------------------------------------------------------------------------
# FIXED VALUES: silver CASE mappings (raw value -> normalised value)
# ---------------------------------------------------------------------------
DECISION_MAP = {
    "approve": "APPROVED", "decline": "DECLINED", "review": "UNDER_REVIEW",
    "challenge": "CHALLENGED", "block": "BLOCKED",
}
METHOD_DISPLAY_NAMES = {
    "CREDIT_CARD": "Credit Card", "DEBIT_CARD": "Debit Card", "ACH": "Bank Transfer (ACH)",
    "WIRE": "Wire Transfer", "DIGITAL_WALLET": "Digital Wallet",
}
METHOD_CATEGORIES = {
    "CREDIT_CARD": "Card", "DEBIT_CARD": "Card", "ACH": "Bank", "WIRE": "Bank",
    "DIGITAL_WALLET": "Wallet",
}
CURRENCY_SYMBOLS = {"USD": "$", "EUR": "€", "GBP": "£", "JPY": "¥"}

# ---------------------------------------------------------------------------
# FIXED VALUES: thresholds
# ---------------------------------------------------------------------------
MIN_AMOUNT = "0.01"
MAX_AMOUNT = "999999.99"
# silver risk level (pipeline A) and fraud engine score levels
RISK_LEVEL_CUTS = [("LOW", 0.25), ("MEDIUM", 0.5), ("HIGH", 0.75)]  # else CRITICAL
# pipeline B classification: >= 0.8 HIGH, >= 0.5 MODERATE, >= 0.2 LOW, else MINIMAL
RISK_CLASS_B_CUTS = [("HIGH", 0.8), ("MODERATE", 0.5), ("LOW", 0.2)]
# customer profile: > 0.7 VERY_HIGH_RISK, > 0.5 HIGH_RISK, > 0.25 MEDIUM_RISK, else LOW_RISK
CUSTOMER_RISK_CUTS = [("VERY_HIGH_RISK", 0.7), ("HIGH_RISK", 0.5), ("MEDIUM_RISK", 0.25)]

# fraud engine defaults
ENGINE_BASE_SCORE = "0.10"
ENGINE_MAX_AMOUNT = "10000.00"
ENGINE_VELOCITY_LIMIT = 5
ENGINE_WINDOW_MINUTES = 60
RULE_WEIGHTS = {
    "amount_anomaly": "0.30",
    "velocity_exceeded": "0.20",
    "unusual_location": "0.15",
    "device_fingerprint_mismatch": "0.15",
}
# alerts that turn a HIGH level into DECLINE instead of REVIEW
ESCALATING_ALERTS = ["bin_blacklist", "velocity_by_ip"]

# ---------------------------------------------------------------------------
# FIXED VALUES: PCI column classifier word lists (substring match, lower case)
# ---------------------------------------------------------------------------
PCI_RESTRICTED_WORDS = [
    "card_number", "pan", "primary_account_number",
    "cvv", "cvc", "security_code", "verification_code",
    "cardholder_name", "expiration_date", "expiry_date", "exp_date",
    "pin", "pin_block", "track_data", "full_track",
    "ksn", "key_serial_number",
]
PII_WORDS = ["ssn", "email", "phone", "customer_id"]
TOKENIZE_WORDS = ["card", "pan", "cvv", "cvc", "pin"]
PARTIAL_MASK_WORDS = ["name", "email", "phone"]

# governance view table groups
PCI_TABLES = ["payments_raw", "payments_cleaned", "payments_with_fraud", "transactions_fact", "fact_transactions"]
PII_TABLES = ["dim_customer"]

MASKED_PLACEHOLDER = "****MASKED****"
TOKEN_PREFIX = "tok_"

# routing topics (suffixes after the prefix)
TOPIC_ALERTS = "alerts"
TOPIC_SIGNALS = "signals"
TOPIC_DECISIONS = "decisions"

# reconciliation / alert defaults
MAX_MISMATCH_COUNT = 100
FRAUD_SPIKE_PCT = 10.0
STREAM_LAG_SECONDS = 60
WATERMARK_DELAY = "30 minutes"
SETTLEMENT_FILES_PER_TRIGGER = 100
RETENTION_DAYS = 90
CALENDAR_DAYS = 730
