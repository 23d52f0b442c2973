"""Column-building helpers; every function returns a pyspark ``Column``."""

from .casts import as_of_ts, cast_money, cast_score, cast_timestamp, parse_failed  # noqa: F401
from .crypto import hash_column, hmac_column, token_for, verify_hmac  # noqa: F401
from .masks import (mask_by_user, mask_card, mask_card_token_variant, mask_cvv, mask_email,  # noqa: F401
                    mask_name, mask_phone, redact_text)
from .normalize import (entity_name, format_currency, lookup, method_category, method_name,  # noqa: F401
                        normalize_case_status, normalize_decision, normalize_payment_method,
                        normalize_status)
from .risk import (customer_risk_class, decide, derive_risk_class_b, derive_risk_level,  # noqa: F401
                   is_high_risk, overall_risk_category, pct_rate, score_to_level, should_decline)
from .validation import (payment_record_ok, signal_record_ok, transaction_record_ok,  # noqa: F401
                         validate_amount, validate_currency, validate_ids, validate_method,
                         validation_error)
