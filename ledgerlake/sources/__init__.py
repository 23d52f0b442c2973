"""Sources: declared-schema readers, fixtures over the driver tables, typed landings."""

from .fixtures import AS_OF, fixture, oracle_ctes  # noqa: F401
from .tables import (read_fraud_raw, read_fraud_signals, read_payment_transactions,  # noqa: F401
                     read_payments_raw, table)
from .typed import enforce_schema, to_fraud_signals_typed, to_payment_transactions  # noqa: F401
