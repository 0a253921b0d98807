"""Contacts and suppliers: listing, id validation, contact audit, validated
supplier load (A18, A19, B19, C17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import flag, ne, truthy
from ..params import SUPPLIER_ID_PATTERN

EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def supplier_listing(contacts: DataFrame) -> DataFrame:
    """Suppliers in the web listing's field names."""
    return contacts.select(F.col("SUPPLR").alias("supplier"), F.col("SUPPLR_NAME").alias("supplier_name"),
                           F.col("EMAIL").alias("email"))


def valid_supplier_ids(listing: DataFrame) -> DataFrame:
    """Whole-match supplier id test; null ids are not valid."""
    return listing.select("SUPPLR", truthy(F.col("SUPPLR").rlike(SUPPLIER_ID_PATTERN)).alias("VALID"))


def contact_audit(listing: DataFrame, contacts: DataFrame) -> DataFrame:
    """C17: vendor listing vs contact sheet.

    DIFFERS: the two e-mails differ (null counts as different);
    KNOWN: the sheet's e-mail appears anywhere in the listing's e-mails.
    """
    lst = (listing.where(F.col("SUPPLR").isNotNull() & ne("SUPPLR", F.lit("T999")))
           .select("SUPPLR", "SUPPLRDES", F.col("EMAIL").alias("EMAIL_x")))
    sheet = contacts.select("SUPPLR", F.col("EMAIL").alias("EMAIL_y"))
    known = lst.select(F.col("EMAIL_x").alias("_known")).where(F.col("_known").isNotNull()).distinct()
    out = lst.join(sheet, "SUPPLR", "left")
    out = out.join(known, out["EMAIL_y"] == known["_known"], "left")
    return out.select("SUPPLR", "SUPPLRDES", "EMAIL_x", "EMAIL_y",
                      flag(ne("EMAIL_x", "EMAIL_y")).alias("DIFFERS"),
                      flag(F.col("_known").isNotNull()).alias("KNOWN"))


def validate_suppliers(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Batch validation of a supplier upload.

    Returns every row with ``REASON`` (null when accepted): lengths 20/100/200,
    e-mail form, key repeated in the batch, key already stored.
    """
    counts = batch.groupBy("SUPPLR").agg(F.count(F.lit(1)).alias("_n"))
    out = batch.join(counts, batch["SUPPLR"].eqNullSafe(counts["SUPPLR"]), "left").drop(counts["SUPPLR"])
    if existing is not None:
        keys = existing.select(F.col("SUPPLR").alias("_stored")).distinct()
        out = out.join(keys, out["SUPPLR"] == keys["_stored"], "left")
    else:
        out = out.withColumn("_stored", F.lit(None).cast("string"))
    reason = (F.when(F.col("SUPPLR").isNull() | (F.length("SUPPLR") == 0), "missing key")
              .when(F.length("SUPPLR") > 20, "SUPPLR too long")
              .when(F.length("SUPPLR_NAME") > 100, "SUPPLR_NAME too long")
              .when(F.length("EMAIL") > 200, "EMAIL too long")
              .when(~truthy(F.col("EMAIL").rlike(EMAIL_PATTERN)), "bad EMAIL")
              .when(F.col("_n") > 1, "duplicate key")
              .when(F.col("_stored").isNotNull(), "key exists"))
    return out.withColumn("REASON", reason).drop("_n", "_stored")
