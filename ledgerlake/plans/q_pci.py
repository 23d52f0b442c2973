"""Registered queries of the PCI block.

Sensitive values come from ``fx_cardholders`` (derived from ``customer``) and from the
free-text tables (documents, pages, conversations).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import crypto, masks, sensitive
from ..operators import pci, vault
from ..session import scratch_path
from ..sources.tables import TEST_TABLES
from .oracle_sql import sql_with
from .registry import register

# FIXED VALUE: the fixture key for tokens and HMACs (a real deployment passes its own key)
FIXTURE_KEY = "fixture-signing-key"
IPAD, OPAD = crypto.hmac_pads(FIXTURE_KEY)

CARDHOLDER_COLS = ["holder_id", "card_number", "cvv", "cardholder_name", "email", "phone", "expiration_date", "amount"]


def hmac_sql(x: str) -> str:
    return f"sha256(unhex('{OPAD}') || unhex(sha256(unhex('{IPAD}') || encode({x}))))"


def token_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE 'tok_' || substr({hmac_sql(x)}, 1, 32) END"


def _in_words(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


def classify_sql(name_col: str = "column_name") -> str:
    n = f"lower({name_col})"
    r, p = _in_words(n, K.PCI_RESTRICTED_WORDS), _in_words(n, K.PII_WORDS)
    return (f"CASE WHEN {r} THEN 'pci_dss_restricted' WHEN {p} THEN 'pii_restricted' ELSE 'internal' END AS classification, "
            f"({r} OR {p}) AS is_masked, "
            f"CASE WHEN NOT ({r} OR {p}) THEN NULL WHEN {_in_words(n, K.TOKENIZE_WORDS)} THEN 'tokenize' "
            f"WHEN {_in_words(n, K.PARTIAL_MASK_WORDS)} THEN 'partial' ELSE 'redact' END AS mask_type")


# text columns whose values are looked at, by table
TEXT_COLUMNS = {
    "region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"], "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"], "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"], "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"], "pages": ["url", "html"], "benchmark": ["text"],
    "conversations": ["role", "text"],
    "fx_cardholders": ["holder_id", "card_number", "cvv", "cardholder_name", "email", "phone", "expiration_date"],
}


def _scan_sql(tables: dict) -> str:
    """One pass per table: all counters in one aggregate, unpivoted to one row per column and pattern."""
    parts = []
    for t, cols in tables.items():
        pairs = [(c, p) for c in cols for p in sensitive.HELD]
        counters = ", ".join(f"COUNT(*) FILTER (WHERE {sensitive.held_sql(p, c)}) AS m{i}" for i, (c, p) in enumerate(pairs))
        rows = ", ".join(f"{{'column_name': '{c}', 'pattern': '{p}', 'matches': m{i}}}" for i, (c, p) in enumerate(pairs))
        parts.append(f"SELECT '{t}' AS table_name, r.column_name, r.pattern, r.matches, total AS total_values, r.matches / total AS share "
                     f"FROM (SELECT total, unnest([{rows}]) AS r FROM (SELECT COUNT(*) AS total, {counters} FROM {t}) w) u")
    return "\nUNION ALL ".join(parts)


def _scan_frames(ctx, tables: dict):
    out = None
    for t, cols in tables.items():
        one = pci.scan_sensitive_values(ctx.fx(t).select(*cols), t, cols)
        out = one if out is None else out.unionByName(one)
    return out


_CARD_LIST = ", ".join(f"'{c}'" for c in CARDHOLDER_COLS)
PCI_LAYERS = {
    "cols": ([], "\nUNION ALL ".join(
        [f"SELECT 'testdata' AS schema_name, '{t}' AS table_name, column_name FROM (DESCRIBE {t})" for t in TEST_TABLES]
        + [f"SELECT 'testdata', 'fx_cardholders', unnest([{_CARD_LIST}])"])),
    "named": (["cols"], f"SELECT schema_name, table_name, column_name, {classify_sql()} FROM cols"),
    "value_scan": (["fx_cardholders"], _scan_sql(TEXT_COLUMNS)),
    "value_class": (["value_scan"], """
SELECT table_name, column_name,
       CASE WHEN COALESCE(bool_or(share >= 0.5 AND pattern = 'card'), false) THEN 'pci_dss_restricted'
            WHEN COALESCE(bool_or(share >= 0.5 AND pattern <> 'card'), false) THEN 'pii_restricted' ELSE 'internal' END AS v
FROM value_scan GROUP BY table_name, column_name"""),
    "classified": (["named", "value_class"], """
SELECT schema_name, table_name, column_name, classification, classification <> 'internal' AS is_masked,
       COALESCE(mask_type, CASE WHEN classification <> 'internal' THEN 'redact' END) AS mask_type
FROM (SELECT n.schema_name, n.table_name, n.column_name, n.mask_type,
             CASE WHEN 'pci_dss_restricted' IN (n.classification, COALESCE(v.v, '')) THEN 'pci_dss_restricted'
                  WHEN 'pii_restricted' IN (n.classification, COALESCE(v.v, '')) THEN 'pii_restricted'
                  ELSE 'internal' END AS classification
      FROM named n LEFT JOIN value_class v ON n.table_name = v.table_name AND n.column_name = v.column_name) c"""),
}


def _columns(ctx):
    tables = {t: ctx.fx(t) for t in TEST_TABLES}
    tables["fx_cardholders"] = ctx.fx("fx_cardholders")
    return pci.columns_frame(ctx.spark, tables, "testdata")


def _classified(ctx):
    """Every column of the tables, classed by its name and by what its values look like."""
    return pci.classify_names_and_values(pci.classify_columns(_columns(ctx)),
                                         pci.classify_values(_scan_frames(ctx, TEXT_COLUMNS)))


def _with_cols(final: str) -> str:
    return sql_with(["classified"], final, extra=PCI_LAYERS)


CLASS_OUT = "schema_name, table_name, column_name, classification, is_masked, mask_type"


@register("classify_columns", _with_cols(f"SELECT {CLASS_OUT} FROM classified"))
def _classify(ctx):
    return _classified(ctx).select(*[c.strip() for c in CLASS_OUT.split(",")])


@register("restricted_fields", _with_cols("SELECT table_name, column_name FROM classified "
                                          "WHERE classification = 'pci_dss_restricted'"))
def _restricted(ctx):
    return pci.restricted_fields(_classified(ctx)).select("table_name", "column_name")


@register("pii_fields", _with_cols("SELECT table_name, column_name FROM classified WHERE classification = 'pii_restricted'"))
def _pii(ctx):
    return pci.pii_fields(_classified(ctx)).select("table_name", "column_name")


@register("column_inventory", _with_cols("""SELECT schema_name, table_name, column_name, classification,
       classification = 'pci_dss_restricted' AS is_pci_dss, is_masked AS requires_masking FROM classified"""))
def _inventory(ctx):
    inv = pci.column_inventory(_classified(ctx))
    return pci.flatten_inventory(inv).select("schema_name", "table_name", "column_name", "classification",
                                             "is_pci_dss", "requires_masking")


# ---- masks -----------------------------------------------------------------

MASK_CARD_SQL = "CASE WHEN {c} IS NULL OR length({c}) < 4 THEN '****' ELSE repeat('*', length({c}) - 4) || right({c}, 4) END"
MASK_CARD_TOKEN_SQL = ("CASE WHEN length({c}) < 4 THEN repeat('*', length({c})) "
                       "ELSE repeat('*', length({c}) - 4) || right({c}, 4) END")
MASK_NAME_SQL = ("CASE WHEN {c} IS NULL OR regexp_extract({c}, '^\\s*(\\S)', 1) = '' THEN '***' "
                 "ELSE regexp_extract({c}, '^\\s*(\\S)', 1) || '***' END")
MASK_EMAIL_SQL = ("CASE WHEN {c} IS NULL THEN NULL WHEN len(string_split({c}, '@')) = 2 "
                  "AND length(string_split({c}, '@')[1]) > 0 THEN substr({c}, 1, 1) || '***@' || string_split({c}, '@')[2] "
                  "ELSE '***' END")
MASK_PHONE_SQL = "CASE WHEN length({c}) < 4 THEN '****' ELSE repeat('*', length({c}) - 4) || right({c}, 4) END"


def _mask_query(name, col, fn, sql_tpl):
    @register(name, sql_with(["fx_cardholders"], f"SELECT holder_id, {col}, {sql_tpl.format(c=col)} AS masked "
                                                 f"FROM fx_cardholders"))
    def _q(ctx):
        return ctx.fx("fx_cardholders").select("holder_id", col, fn(col).alias("masked"))
    return _q


_mask_query("mask_card", "card_number", masks.mask_card, MASK_CARD_SQL)
_mask_query("mask_card_token_variant", "card_number", masks.mask_card_token_variant, MASK_CARD_TOKEN_SQL)
_mask_query("mask_cvv", "cvv", masks.mask_cvv, "'***'")
_mask_query("mask_name", "cardholder_name", masks.mask_name, MASK_NAME_SQL)
_mask_query("mask_email", "email", masks.mask_email, MASK_EMAIL_SQL)
_mask_query("mask_phone", "phone", masks.mask_phone, MASK_PHONE_SQL)


@register("mask_table", sql_with(["fx_cardholders"], f"""
SELECT holder_id, {MASK_CARD_SQL.format(c='card_number')} AS card_number, '***' AS cvv,
       {MASK_NAME_SQL.format(c='cardholder_name')} AS cardholder_name, {MASK_EMAIL_SQL.format(c='email')} AS email,
       {MASK_PHONE_SQL.format(c='phone')} AS phone,
       CASE WHEN expiration_date IS NULL THEN NULL ELSE '***' END AS expiration_date, amount
FROM fx_cardholders"""))
def _mask_table(ctx):
    holders = ctx.fx("fx_cardholders")
    classified = pci.classify_columns(pci.columns_frame(ctx.spark, {"fx_cardholders": holders}, "testdata"))
    return pci.mask_table(holders, classified, "fx_cardholders")


def redact_sql(text: str) -> str:
    return (f"regexp_replace(regexp_replace({sensitive.mask_cards_sql(text)}, '{masks.PHONE_PATTERN}', '***-***-\\1', 'g'), "
            "'([A-Za-z0-9._%+-])[A-Za-z0-9._%+-]*@([A-Za-z0-9.-]+\\.[A-Za-z]{2,})', '\\1***@\\2', 'g')")


REDACT_SQL = redact_sql("text")


@register("redact_text", f"""
SELECT doc_id, sha256(r) AS redacted_sha256, CAST(length(r) AS INTEGER) AS redacted_length, r <> text AS changed
FROM (SELECT doc_id, text, {REDACT_SQL} AS r FROM documents) d""")
def _redact(ctx):
    d = ctx.fx("documents").select("doc_id", "text")
    r = masks.redact_text("text")
    return d.select("doc_id", F.sha2(r, 256).alias("redacted_sha256"), F.length(r).alias("redacted_length"),
                    (r != F.col("text")).alias("changed"))


@register("mask_by_user", sql_with(["fx_cardholders"], """
SELECT h.holder_id, u.reader, CASE WHEN u.reader IN (SELECT s_name FROM supplier WHERE s_nationkey < 12) THEN h.card_number
       ELSE '****MASKED****' END AS card_number
FROM fx_cardholders h JOIN (SELECT s_nationkey AS k, MIN(s_name) AS reader FROM supplier GROUP BY s_nationkey) u
  ON CAST(substr(h.holder_id, 2) AS BIGINT) % 25 = u.k"""))
def _mask_by_user(ctx):
    """Suppliers stand for users: those of nations 0 to 11 are in the allowed-users table. Every card is read by one user."""
    suppliers = ctx.fx("supplier")
    allowed = suppliers.filter(F.col("s_nationkey") < 12).select("s_name")
    readers = suppliers.groupBy(F.col("s_nationkey").alias("k")).agg(F.min("s_name").alias("reader"))
    h = ctx.fx("fx_cardholders").select("holder_id", "card_number")
    read = h.join(readers, F.substring("holder_id", 2, 1 << 20).cast("bigint") % 25 == F.col("k"))
    return masks.mask_by_users_table(read, ["card_number"], allowed, F.col("reader")).select("holder_id", "reader", "card_number")


@register("mask_for_session_user", sql_with(["fx_cardholders"], """
SELECT holder_id, '****MASKED****' AS card_number, '****MASKED****' AS email FROM fx_cardholders"""))
def _mask_for_session_user(ctx):
    """The session's user against a table of allowed users that does not hold them: nothing in clear."""
    h = ctx.fx("fx_cardholders").select("holder_id", "card_number", "email")
    return masks.mask_by_users_table(h, ["card_number", "email"], ctx.fx("supplier").select("s_name"))


# ---- tokens, hashes --------------------------------------------------------

def keyring(ctx):
    """The fixture's keyring: written once per context, then only read."""
    if "_keyring" not in ctx._memo:
        path = scratch_path(ctx.spark, "keyring")
        vault.write_keyring(ctx.spark, path, FIXTURE_KEY, {"v1": "first vault secret", "v2": "second vault secret"}, active="v1")
        ctx._memo["_keyring"] = vault.read_keyring(ctx.spark, path)
    return ctx._memo["_keyring"]


def token_key(ctx):
    return vault.token_key(keyring(ctx))


def _tokenized(ctx):
    return vault.tokenize(ctx.fx("fx_cardholders").select("holder_id", "card_number", "cardholder_name"),
                          "card_number", keyring(ctx), "card_token")


def _stored_vault(ctx):
    """The vault as a written table."""
    path = scratch_path(ctx.spark, "vault")
    _tokenized(ctx)[1].write.parquet(path)
    return ctx.spark.read.parquet(path)


@register("tokenize_column", sql_with(["fx_cardholders"], f"""
SELECT holder_id, {token_sql('card_number')} AS card_token FROM fx_cardholders"""))
def _tokenize(ctx):
    out, _vault = _tokenized(ctx)
    return out.select("holder_id", "card_token")


_DETOK_SQL = sql_with(["fx_cardholders"], f"""
SELECT holder_id, {token_sql('card_number')} AS card_token, v.value AS card_number
FROM fx_cardholders h
LEFT JOIN (SELECT DISTINCT {token_sql('card_number')} AS token, card_number AS value FROM fx_cardholders
           WHERE card_number IS NOT NULL) v ON {token_sql('h.card_number')} = v.token""")


@register("detokenize", _DETOK_SQL)
def _detokenize(ctx):
    out = _tokenized(ctx)[0].select("holder_id", "card_token")
    return vault.detokenize(out, "card_token", _stored_vault(ctx), keyring(ctx), "card_number").select("holder_id", "card_token", "card_number")


@register("rotate_vault", sql_with(["fx_cardholders"], f"""
SELECT DISTINCT {token_sql('card_number')} AS token, 'v2' AS key_id, card_number AS value FROM fx_cardholders WHERE card_number IS NOT NULL"""))
def _rotate(ctx):
    """A vault sealed under key v1 after a rotation to v2: tokens and values as before, every row under the new key. The old
    key is then dropped from the keyring."""
    path = scratch_path(ctx.spark, "keyring")
    both = vault.read_keyring(ctx.spark, vault.write_keyring(ctx.spark, f"{path}/both", FIXTURE_KEY, {"v1": "first vault secret", "v2": "second vault secret"}, active="v2"))
    only = vault.read_keyring(ctx.spark, vault.write_keyring(ctx.spark, f"{path}/new", FIXTURE_KEY, {"v2": "second vault secret"}, active="v2"))
    return vault.opened(vault.rotated(_stored_vault(ctx), both), only).select("token", "key_id", "value")


_REVOKE_SQL = sql_with(["fx_cardholders"], f"""
SELECT token, token IN (SELECT {token_sql('card_number')} FROM fx_cardholders) AS revoked
FROM (SELECT DISTINCT token FROM (
        SELECT {token_sql('card_number')} AS token FROM fx_cardholders WHERE cardholder_name LIKE 'automobile%'
        UNION ALL
        SELECT 'tok_' || lpad(holder_id, 16, '0') FROM fx_cardholders WHERE cardholder_name LIKE 'building%') r
      WHERE token IS NOT NULL) q""")


def _revoked(ctx):
    h = ctx.fx("fx_cardholders")
    req = (h.filter(F.col("cardholder_name").like("automobile%")).select(crypto.token_for("card_number", token_key(ctx))
                                                                         .alias("token"))
           .unionByName(h.filter(F.col("cardholder_name").like("building%"))
                        .select(F.concat(F.lit("tok_"), F.lpad("holder_id", 16, "0")).alias("token")))
           .filter(F.col("token").isNotNull()))
    return pci.revoke_tokens(_stored_vault(ctx), req)


@register("revoke_tokens", _REVOKE_SQL)
def _revoke(ctx):
    return _revoked(ctx)[1]


@register("revoke_tokens_remaining", sql_with(["fx_cardholders"], f"""
SELECT DISTINCT {token_sql('card_number')} AS token, card_number AS value FROM fx_cardholders
WHERE card_number IS NOT NULL AND card_number NOT IN (SELECT card_number FROM fx_cardholders WHERE cardholder_name LIKE 'automobile%' AND card_number IS NOT NULL)"""))
def _remaining(ctx):
    """What a vault still opens after the revocation."""
    return vault.opened(_revoked(ctx)[0], keyring(ctx)).select("token", "value")


@register("token_collisions", sql_with(["fx_cardholders"], f"""
SELECT token, COUNT(DISTINCT card_number) AS n_values
FROM (SELECT substr({token_sql('card_number')}, 1, 6) AS token, card_number FROM fx_cardholders WHERE card_number IS NOT NULL) v
GROUP BY token HAVING COUNT(DISTINCT card_number) > 1"""))
def _collisions(ctx):
    """The vault check on tokens cut to two hex characters, where values do collide."""
    h = ctx.fx("fx_cardholders").filter(F.col("card_number").isNotNull())
    return pci.token_collisions(h.select(crypto.token_for("card_number", token_key(ctx), length=2).alias("token"),
                                         F.col("card_number").alias("value")))


@register("hash_column", sql_with(["fx_cardholders"], "SELECT holder_id, sha256(email) AS email_sha256 FROM fx_cardholders"))
def _hash(ctx):
    return ctx.fx("fx_cardholders").select("holder_id", crypto.hash_column("email", 256).alias("email_sha256"))


@register("hmac_column", sql_with(["fx_cardholders"], f"SELECT holder_id, {hmac_sql('card_number')} AS card_hmac "
                                                      f"FROM fx_cardholders"))
def _hmac(ctx):
    return ctx.fx("fx_cardholders").select("holder_id", crypto.hmac_column("card_number", token_key(ctx)).alias("card_hmac"))


@register("verify_hmac", sql_with(["fx_cardholders"], f"""
SELECT holder_id, CASE WHEN length(phone) < 4 THEN {hmac_sql('phone')} ELSE {hmac_sql('email')} END = {hmac_sql('email')}
       AS signature_valid
FROM fx_cardholders"""))
def _verify(ctx):
    h = ctx.fx("fx_cardholders")
    key = token_key(ctx)
    sig = F.when(F.length("phone") < 4, crypto.hmac_column("phone", key)).otherwise(crypto.hmac_column("email", key))
    return h.select("holder_id", crypto.verify_hmac("email", sig, key).alias("signature_valid"))


# ---- governance ------------------------------------------------------------

INVENTORY = [("raw", "payments_raw", "MANAGED"), ("raw", "fraud_signals_raw", "MANAGED"),
             ("silver", "payments_cleaned", "MANAGED"), ("silver", "fraud_signals_cleaned", "MANAGED"),
             ("silver", "payments_with_fraud", "MANAGED"), ("silver", "transactions_fact", "MANAGED"),
             ("gold", "dim_date", "MANAGED"), ("gold", "dim_merchant", "MANAGED"), ("gold", "dim_customer", "MANAGED"),
             ("gold", "dim_payment_method", "MANAGED"), ("gold", "fact_transactions", "MANAGED"),
             ("gold", "metric_daily_payment_summary", "VIEW"), ("gold", "metric_fraud_analytics", "VIEW"),
             ("gold", "metric_customer_risk_profile", "VIEW")]
_SOURCE = {"payments_raw": "fx_payments_raw", "fraud_signals_raw": "fx_fraud_signals_raw"}


def table_inventory(ctx):
    """(schema_name, table_name, table_type, row_count) over the pipeline's own tables."""
    m = ctx.med
    frames = {"payments_raw": ctx.fx("fx_payments_raw"), "fraud_signals_raw": ctx.fx("fx_fraud_signals_raw")}
    out = None
    for schema, name, kind in INVENTORY:
        df = frames.get(name) if name in frames else getattr(m, name)
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(schema).alias("schema_name"), F.lit(name).alias("table_name"), F.lit(kind).alias("table_type"),
            "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def listed_tables(ctx):
    """(schema_name, table_name, table_type) without row counts, as a catalog listing gives it."""
    return ctx.spark.createDataFrame(INVENTORY, "schema_name string, table_name string, table_type string")


def _inventory_sql() -> str:
    parts = [f"SELECT '{s}' AS schema_name, '{n}' AS table_name, '{k}' AS table_type, "
             f"(SELECT COUNT(*) FROM {_SOURCE.get(n, n)}) AS row_count" for s, n, k in INVENTORY]
    return " UNION ALL ".join(parts)


def _gov_body() -> str:
    pci_list = ", ".join(f"'{t}'" for t in K.PCI_TABLES)
    pii_list = ", ".join(f"'{t}'" for t in K.PII_TABLES)
    return f"""
SELECT 'payments' AS catalog_name, schema_name, table_name, table_type, row_count,
       CASE WHEN table_name LIKE '%raw%' THEN 'RAW (Bronze)'
            WHEN table_name LIKE '%cleaned%' OR table_name LIKE '%fraud%' THEN 'SILVER (Transformation)'
            ELSE 'GOLD (Analytics)' END AS layer,
       CASE WHEN table_name IN ({pci_list}) THEN 'PCI-DSS Restricted' WHEN table_name IN ({pii_list}) THEN 'PII Restricted'
            ELSE 'Internal/Public' END AS data_sensitivity,
       table_name IN ({pci_list}) AS is_pci_dss_restricted,
       table_name IN ({pci_list}) OR table_name IN ({pii_list}) AS requires_encryption,
       CASE WHEN table_name IN ({pci_list}) THEN 'Restricted Access - Finance/Compliance Only'
            WHEN table_name IN ({pii_list}) THEN 'Restricted Access - Analytics/Finance Only'
            ELSE 'Standard Access' END AS access_level
FROM inventory"""


GOV_LAYERS = dict(PCI_LAYERS)
GOV_LAYERS["inventory"] = (["fx_payments_raw", "fx_fraud_signals_raw"] + [n for _s, n, _k in INVENTORY if n not in _SOURCE],
                           _inventory_sql())
GOV_LAYERS["gov"] = (["inventory"], _gov_body())


def _gov_sql(order: bool) -> str:
    final = "SELECT * FROM gov" + (" ORDER BY schema_name, table_name" if order else "")
    return sql_with(["gov"], final, extra=GOV_LAYERS)


GOV_COLS = ["catalog_name", "schema_name", "table_name", "table_type", "row_count", "layer", "data_sensitivity",
            "is_pci_dss_restricted", "requires_encryption", "access_level"]


@register("v_data_governance_summary", _gov_sql(False))
def _governance(ctx):
    return pci.governance_summary(table_inventory(ctx)).select(*GOV_COLS)


@register("sort_governance", _gov_sql(True))
def _sort_governance(ctx):
    return pci.sort_governance(pci.governance_summary(table_inventory(ctx)).select(*GOV_COLS))


# ---- audit and value scan --------------------------------------------------

# silver and gold tables whose text is searched for values in clear, with the text columns for the oracle
AUDITED = {
    "payments_cleaned": ["payment_id", "merchant_id", "customer_id", "currency", "payment_method_normalized", "status_normalized"],
    "fraud_signals_cleaned": ["signal_id", "transaction_id", "risk_level_derived", "risk_level", "alerts", "decision_normalized", "case_status_normalized"],
    "payments_with_fraud": ["payment_id", "merchant_id", "customer_id", "currency", "payment_method", "status", "fraud_risk_level", "fraud_decision",
                            "fraud_alerts", "overall_risk_category"],
    "transactions_fact": ["transaction_id", "merchant_id", "customer_id", "currency", "payment_method", "status", "fraud_risk_level", "fraud_decision",
                          "overall_risk_category"],
    "dim_date": ["date_key", "month_name", "day_name"],
    "dim_merchant": ["merchant_id", "merchant_code", "merchant_name"],
    "dim_customer": ["customer_id", "customer_code", "customer_name"],
    "dim_payment_method": ["payment_method", "method_code", "method_name", "method_category"],
    "fact_transactions": ["transaction_id", "date_key", "merchant_id", "customer_id", "payment_method", "currency", "payment_status", "fraud_risk_level",
                          "fraud_decision", "overall_risk_category"],
    "metric_daily_payment_summary": ["month_name", "day_name"],
    "metric_fraud_analytics": ["merchant_id", "merchant_name"],
    "metric_customer_risk_profile": ["customer_id", "risk_classification", "customer_name"],
}


def _leaks_sql(tables: dict) -> str:
    def clear(cols):
        return " OR ".join([sensitive.held_sql(p, c) for c in cols for p in ("card", "email")] or ["false"])
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) FILTER (WHERE {clear(cols)}) AS leaking FROM {t}"
                              for t, cols in tables.items())


def _audit_sql(leaks: str, stored: str) -> str:
    return f"""
SELECT 'raw_tables_restricted' AS audit_item, 'every raw table is classed as restricted' AS description,
       CASE WHEN COUNT(*) FILTER (WHERE NOT is_pci_dss_restricted) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       COUNT(*) AS checked, COUNT(*) FILTER (WHERE NOT is_pci_dss_restricted) AS violations
FROM gov WHERE schema_name = 'raw'
UNION ALL
SELECT 'no_values_in_clear', 'no card number or e-mail in clear in silver and gold text',
       CASE WHEN COUNT(*) FILTER (WHERE leaking > 0) = 0 THEN 'PASS' ELSE 'FAIL' END, COUNT(*), COUNT(*) FILTER (WHERE leaking > 0)
FROM ({leaks}) l
UNION ALL
SELECT 'restricted_columns_masked', 'every restricted column has a mask',
       CASE WHEN COUNT(*) FILTER (WHERE mask_type IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END, COUNT(*), COUNT(*) FILTER (WHERE mask_type IS NULL)
FROM ({stored}) s WHERE classification = 'pci_dss_restricted'
UNION ALL
SELECT 'columns_classified', 'every column has a stored classification',
       CASE WHEN COUNT(*) FILTER (WHERE s.classification IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END, COUNT(*),
       COUNT(*) FILTER (WHERE s.classification IS NULL)
FROM cols c LEFT JOIN ({stored}) s ON c.table_name = s.table_name AND c.column_name = s.column_name"""


def _text_columns(df) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]


def _leaks(ctx, extra: dict):
    """Leaking rows of every silver and gold table, over all of its text columns."""
    out = None
    tables = {n: getattr(ctx.med, n) for s, n, _kind in INVENTORY if s != "raw"}
    for t, df in {**{t: df.select(*_text_columns(df)) for t, df in tables.items()}, **extra}.items():
        one = pci.leaking_rows(df, t)
        out = one if out is None else out.unionByName(one)
    return out


_STORED_SQL = "SELECT * FROM classified"
# what an earlier classification left out: one table never classified, the masks of one column name removed
_STALE_SQL = """SELECT table_name, column_name, classification, CASE WHEN column_name <> 'cvv' THEN mask_type END AS mask_type
FROM classified WHERE table_name <> 'events'"""
_AUDIT_LAYERS = ["gov", "cols", "classified", "fx_cardholders", *AUDITED]


@register("pci_audit", sql_with(_AUDIT_LAYERS, _audit_sql(_leaks_sql(AUDITED), _STORED_SQL), extra=GOV_LAYERS))
def _audit(ctx):
    """The pipeline's own tables with the masked card table and the full classification."""
    classified = _classified(ctx)
    return pci.audit(pci.governance_summary(listed_tables(ctx)), _columns(ctx), classified, _leaks(ctx, {}))


@register("pci_audit_violations", sql_with(_AUDIT_LAYERS, _audit_sql(
    _leaks_sql({**AUDITED, "fx_cardholders": ["card_number", "email"]}), _STALE_SQL), extra=GOV_LAYERS))
def _audit_violations(ctx):
    """The same audit where card numbers stand in clear in a gold table and the stored classification is stale."""
    stale = (_classified(ctx).filter(F.col("table_name") != "events")
             .withColumn("mask_type", F.when(F.col("column_name") != "cvv", F.col("mask_type"))))
    leaks = _leaks(ctx, {"fx_cardholders": ctx.fx("fx_cardholders").select("card_number", "email")})
    return pci.audit(pci.governance_summary(listed_tables(ctx)), _columns(ctx), stale, leaks)


@register("find_card_numbers", sql_with(["fx_card_notes"], f"""
SELECT holder_id, CASE WHEN kind IN (0, 1, 3) THEN 1 ELSE 0 END AS n_cards, {redact_sql('note')} AS redacted FROM fx_card_notes"""))
def _find_cards(ctx):
    """Notes with dashed, spaced and 15-digit card numbers, and with order numbers that fail the check or are too long."""
    notes = ctx.fx("fx_card_notes")
    return notes.select("holder_id", F.size(sensitive.card_numbers(F.col("note"))).alias("n_cards"), masks.redact_text("note").alias("redacted"))


SCAN_TABLES = {t: cols for t, cols in TEXT_COLUMNS.items() if t != "fx_cardholders"}


@register("scan_sensitive_values", _scan_sql(SCAN_TABLES))
def _scan(ctx):
    return _scan_frames(ctx, SCAN_TABLES)
