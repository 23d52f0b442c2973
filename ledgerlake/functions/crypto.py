"""Hashes, HMAC-SHA256 and deterministic tokens as native Spark expressions.

HMAC(K, m) = H((K' xor opad) || H((K' xor ipad) || m)) with SHA-256 (block size 64).
The two padded keys depend only on the key; the per-row work is two ``sha2`` calls. A key is a ``KeyRef`` to pads in a
keyring table (``operators.vault``), which keeps it out of plans, or a text, whose pads are computed once on the driver and enter
the plan as binary literals: for tests and one-off work. ``build_session`` sets ``spark.sql.redaction.string.regex`` (``PAD_REDACTION``)
so that plan texts do not show such literals.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

_BLOCK = 64
PAD_REDACTION = "(?i)[0-9a-f]{128}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hmac_pads(key: str) -> tuple[str, str]:
    """(ipad_hex, opad_hex) for a text key."""
    kb = key.encode("utf-8")
    if len(kb) > _BLOCK:
        kb = hashlib.sha256(kb).digest()
    kb = kb.ljust(_BLOCK, b"\x00")
    ipad = bytes(b ^ 0x36 for b in kb)
    opad = bytes(b ^ 0x5C for b in kb)
    return ipad.hex(), opad.hex()


def hash_column(c, bits: int = 256) -> Column:
    """sha256 / sha512 hex digest of the UTF-8 text."""
    if bits not in (256, 512):
        raise ValueError("bits must be 256 or 512")
    return F.sha2(_c(c).cast("string"), bits)


@dataclass(frozen=True)
class KeyRef:
    """The pads of a key as columns (of a keyring)."""
    ipad: Column
    opad: Column


def _pads(key: str | KeyRef) -> tuple[Column, Column]:
    if isinstance(key, KeyRef):
        return key.ipad, key.opad
    if not key:
        raise ValueError("an HMAC key is required")
    ipad, opad = hmac_pads(key)
    return F.unhex(F.lit(ipad)), F.unhex(F.lit(opad))


def hmac_column(c, key: str | KeyRef) -> Column:
    """HMAC-SHA256 hex digest (equal to Python's hmac.new(key, data, sha256).hexdigest())."""
    ipad, opad = _pads(key)
    inner = F.sha2(F.concat(ipad, F.encode(_c(c).cast("string"), "UTF-8")), 256)
    return F.sha2(F.concat(opad, F.unhex(inner)), 256)


def verify_hmac(c, signature, key: str | KeyRef) -> Column:
    return hmac_column(c, key) == _c(signature)


def token_for(c, key: str | KeyRef, length: int = 32) -> Column:
    """'tok_' + first 32 hex characters (128 bits) of the keyed HMAC: the same value always gets the
    same token, so retries and re-runs are stable; two of 10^12 values meet with probability 10^-15.
    ``pci.token_collisions`` lists such tokens of a vault."""
    return F.when(_c(c).isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(K.TOKEN_PREFIX), F.substring(hmac_column(c, key), 1, length)))
