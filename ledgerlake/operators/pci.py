"""PCI-DSS operators: column classification, table masking, tokens, governance views.

Classification works on a DataFrame of (table_name, column_name, data_type) built from
the schemas of the tables themselves, so wide catalogs are classified by Spark like any
other table. Only the per-table column list (metadata, bounded by the number of columns)
is ever read on the driver, to build a masking projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import crypto, masks, sensitive

COLUMNS_SCHEMA = T.StructType([T.StructField("schema_name", T.StringType()),
                               T.StructField("table_name", T.StringType()),
                               T.StructField("column_name", T.StringType()),
                               T.StructField("data_type", T.StringType())])


def columns_frame(spark: SparkSession, tables: dict[str, DataFrame], schema_name: str = "default") -> DataFrame:
    """(schema_name, table_name, column_name, data_type) of each table's schema."""
    rows = [(schema_name, t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, COLUMNS_SCHEMA)


def _contains_any(c: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [F.instr(c, w) > 0 for w in words])


def classify_columns(columns: DataFrame, column: str = "column_name") -> DataFrame:
    """Adds classification, is_masked and mask_type (substring rules, case-insensitive)."""
    name = F.lower(F.col(column))
    restricted = _contains_any(name, K.PCI_RESTRICTED_WORDS)
    pii = _contains_any(name, K.PII_WORDS)
    classification = (F.when(restricted, F.lit("pci_dss_restricted"))
                      .when(pii, F.lit("pii_restricted")).otherwise(F.lit("internal")))
    masked = restricted | pii
    mask_type = (F.when(~masked, F.lit(None).cast("string"))
                 .when(_contains_any(name, K.TOKENIZE_WORDS), F.lit("tokenize"))
                 .when(_contains_any(name, K.PARTIAL_MASK_WORDS), F.lit("partial"))
                 .otherwise(F.lit("redact")))
    return columns.withColumns({"classification": classification, "is_masked": masked, "mask_type": mask_type})


def restricted_fields(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("classification") == "pci_dss_restricted")


def pii_fields(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("classification") == "pii_restricted")


def mask_table(df: DataFrame, classified: DataFrame, table_name: str) -> DataFrame:
    """Every column of ``table_name`` through the mask its classification asks for; others unchanged."""
    c = classified.filter(F.col("table_name") == table_name)
    plan = {r["column_name"]: r["mask_type"] for r in c.select("column_name", "mask_type").collect()}
    return df.select(*[masks.mask_for_type(plan.get(name), name, F.col(name)).alias(name) for name in df.columns])


# ---- tokens ----------------------------------------------------------------

def tokenize_column(df: DataFrame, col: str, key: str, token_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Replace ``col`` by a deterministic keyed token; return (tokenised df, vault).
    The vault (token, value) is a distinct projection, written by the caller to a
    restricted location."""
    token_col = token_col or col
    tokens = df.withColumn("_token", crypto.token_for(col, key))
    vault = tokens.select(F.col("_token").alias("token"), F.col(col).alias("value")) \
                  .filter(F.col("token").isNotNull()).distinct()
    out = tokens.drop(col).withColumnRenamed("_token", token_col)
    return out, vault


def token_collisions(vault: DataFrame) -> DataFrame:
    """Tokens that stand for more than one value (a vault must have none): (token, n_values)."""
    return vault.groupBy("token").agg(F.count_distinct("value").alias("n_values")).filter(F.col("n_values") > 1)


def detokenize(df: DataFrame, token_col: str, vault: DataFrame, value_col: str = "value") -> DataFrame:
    """token -> original value (NULL for an unknown or revoked token)."""
    v = vault.select(F.col("token").alias(token_col), F.col("value").alias(value_col))
    return df.join(v, on=token_col, how="left")


def revoke_tokens(vault: DataFrame, tokens: DataFrame, token_col: str = "token") -> tuple[DataFrame, DataFrame]:
    """Remove tokens from the vault; report per requested token whether it was found."""
    req = tokens.select(F.col(token_col).alias("token")).distinct()
    remaining = vault.join(req, on="token", how="left_anti")
    found = vault.select("token").distinct().withColumn("revoked", F.lit(True))
    result = req.join(found, on="token", how="left").select("token", F.coalesce("revoked", F.lit(False)).alias("revoked"))
    return remaining, result


# ---- governance views ----------------------------------------------------------

def governance_summary(tables: DataFrame, catalog: str = "payments") -> DataFrame:
    """v_data_governance_summary over a (schema_name, table_name, table_type, ...) inventory.
    The LIKE rules are kept literally (decision D-14)."""
    t = F.col("table_name")
    pci = t.isin(*K.PCI_TABLES)
    pii = t.isin(*K.PII_TABLES)
    return (tables.withColumn("catalog_name", F.lit(catalog)).withColumns({
        "layer": F.when(t.like("%raw%"), F.lit("RAW (Bronze)"))
                  .when(t.like("%cleaned%") | t.like("%fraud%"), F.lit("SILVER (Transformation)"))
                  .otherwise(F.lit("GOLD (Analytics)")),
        "data_sensitivity": F.when(pci, F.lit("PCI-DSS Restricted")).when(pii, F.lit("PII Restricted"))
                             .otherwise(F.lit("Internal/Public")),
        "is_pci_dss_restricted": pci,
        "requires_encryption": pci | pii,
        "access_level": F.when(pci, F.lit("Restricted Access - Finance/Compliance Only"))
                         .when(pii, F.lit("Restricted Access - Analytics/Finance Only"))
                         .otherwise(F.lit("Standard Access")),
    }))


def catalog_tables(spark: SparkSession, databases: list[str] | None = None) -> DataFrame:
    """(schema_name, table_name, table_type) of the catalog's tables and views, the input of
    ``governance_summary`` in deployments with a metastore (metadata only, one row per table)."""
    dbs = databases or [d.name for d in spark.catalog.listDatabases()]
    rows = []
    for db in dbs:
        for t in spark.catalog.listTables(db):
            rows.append((t.namespace[0] if t.namespace else db, t.name, t.tableType))
    schema = "schema_name string, table_name string, table_type string"
    return spark.createDataFrame(rows, schema)


def sort_governance(summary: DataFrame) -> DataFrame:
    return summary.orderBy("schema_name", "table_name")


def column_inventory(classified: DataFrame) -> DataFrame:
    """One row per table with ARRAY<STRUCT(column_name, data_type, classification, is_pci_dss,
    requires_masking)> sorted by column name."""
    item = F.struct(F.col("column_name"), F.col("data_type"), F.col("classification"),
                    (F.col("classification") == "pci_dss_restricted").alias("is_pci_dss"),
                    F.col("is_masked").alias("requires_masking"))
    return (classified.groupBy("schema_name", "table_name")
            .agg(F.array_sort(F.collect_list(item)).alias("columns")))


def flatten_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.select("schema_name", "table_name", F.inline("columns"))


# ---- value scan ----------------------------------------------------------------

def scan_sensitive_values(df: DataFrame, table_name: str, columns: list[str] | None = None,
                          held: dict | None = None) -> DataFrame:
    """Share of values per string column that hold each kind of sensitive value (``sensitive.HELD``): one
    aggregation pass over the table (all counters in one agg), then unpivoted to long form."""
    held = held or sensitive.HELD
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = [(c, p, has) for c in cols for p, has in held.items()]
    aggs = [F.count_if(has(F.col(f"`{c}`"))).alias(f"_m{i}") for i, (c, _, has) in enumerate(pairs)]
    wide = df.select(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_total"), *aggs)
    found = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("pattern"), F.col(f"_m{i}").cast("long").alias("matches"))
                      for i, (c, p, _) in enumerate(pairs)])
    long = wide.select("_total", F.inline(found))
    return long.select(
        F.lit(table_name).alias("table_name"), "column_name", "pattern", "matches",
        F.col("_total").alias("total_values"),
        (F.col("matches") / F.col("_total")).alias("share"))


def classify_values(scan: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Classification that the values themselves ask for, from a ``scan_sensitive_values`` result: card
    numbers in ``min_share`` of a column's values or more make it restricted, e-mails or phones PII."""
    hit = (F.col("share") >= min_share)
    return scan.groupBy("table_name", "column_name").agg(
        F.coalesce(F.bool_or(hit & (F.col("pattern") == "card")), F.lit(False)).alias("_card"),
        F.coalesce(F.bool_or(hit & (F.col("pattern") != "card")), F.lit(False)).alias("_pii")).select(
        "table_name", "column_name",
        F.when(F.col("_card"), "pci_dss_restricted").when(F.col("_pii"), "pii_restricted")
         .otherwise("internal").alias("value_classification"))


def classify_names_and_values(classified: DataFrame, values: DataFrame) -> DataFrame:
    """Name classification raised by value evidence (never lowered); a column that only its values
    give away is redacted. Columns without text values keep the name's class."""
    j = classified.join(values, on=["table_name", "column_name"], how="left")
    name, value = F.col("classification"), F.coalesce("value_classification", F.lit("internal"))
    final = (F.when((name == "pci_dss_restricted") | (value == "pci_dss_restricted"), "pci_dss_restricted")
             .when((name == "pii_restricted") | (value == "pii_restricted"), "pii_restricted").otherwise("internal"))
    return j.withColumns({"classification": final, "is_masked": final != "internal",
                          "mask_type": F.coalesce("mask_type", F.when(final != "internal", F.lit("redact")))}) \
            .drop("value_classification")


# ---- audit -----------------------------------------------------------------------

def leaking_rows(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, rows, leaking): rows with a card number or an e-mail address in any text column."""
    text = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    found = reduce(lambda a, b: a | b, [sensitive.HELD[p](c) for c in text for p in ("card", "email")], F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(found).alias("leaking")).select(
        F.lit(table_name).alias("table_name"), "rows", "leaking")


def audit(inventory: DataFrame, columns: DataFrame, stored: DataFrame, leaks: DataFrame) -> DataFrame:
    """Four checkpoints, each with what was checked and how much of it violates the rule:
    raw tables classed as restricted (``inventory``: governance_summary rows), no card number or e-mail in
    silver and gold text (``leaks``: leaking_rows of each table), a mask for every restricted column and
    a stored classification for every column (``stored`` against the catalog's ``columns``)."""
    def item(df: DataFrame, name: str, rule: str, violation) -> DataFrame:
        counts = df.agg(F.count(F.lit(1)).alias("checked"), F.count_if(violation).alias("violations"))
        return counts.select(F.lit(name).alias("audit_item"), F.lit(rule).alias("description"),
                             F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status"),
                             "checked", "violations")

    raw = item(inventory.filter(F.col("schema_name") == "raw"), "raw_tables_restricted",
               "every raw table is classed as restricted", ~F.col("is_pci_dss_restricted"))
    clear = item(leaks, "no_values_in_clear", "no card number or e-mail in clear in silver and gold text",
                 F.col("leaking") > 0)
    masked = item(stored.filter(F.col("classification") == "pci_dss_restricted"), "restricted_columns_masked",
                  "every restricted column has a mask", F.col("mask_type").isNull())
    known = stored.select("table_name", "column_name", "classification").filter(F.col("classification").isNotNull()) \
                  .distinct().withColumnRenamed("classification", "_known")
    listed = item(columns.join(known, on=["table_name", "column_name"], how="left"), "columns_classified",
                  "every column has a stored classification", F.col("_known").isNull())
    return raw.unionByName(clear).unionByName(masked).unionByName(listed)
