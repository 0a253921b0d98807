"""Job parameters.

The original application reads the clock and a private config folder; here
every such value is an explicit parameter with a fixed default so that runs
are reproducible.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# --- fixed values (defaults shared with the SQL oracles) -------------------
AS_OF = _dt.date(1998, 6, 15)
SEASON = "24"
FIRST_YEAR = 2020
TICKET = "0.25"
DISCOUNT = "0.20"
ROUNDING_ERROR = "0.0001"
SEND_DATE = _dt.date(2024, 1, 15)
MISSING_SHARE = 0.1
LATE_DAYS = 21
DEADLINE_LEAD_DAYS = 10
DATE_ALARM_DAYS = 150
DATE_RESET_DAYS = 100
STOCK_RESET_SHARE = 0.5
PHOTO_ITEM_LIMIT = 99
TRIAGE_MIN_ROWS = 30
REPORT_YEAR = 2025
# rate -> (currency, symbol)
FX_TABLE = ((1.0, "USD", "$"), (7.0, "RMB", "¥"), (30.0, "NT", "NT$"))
# Dummy-order customer code (prefix "Y" + code is stripped from products).
CUSTOMER_CODE = "KX"
# Supplier ids accepted by the web lookups.
SUPPLIER_ID_PATTERN = r"^[A-Z][A-Z0-9]{0,9}$"
# Order-document patterns.
ITEM_CODE_PATTERN = r"\b[A-Z](?:\w*\d){3,}\w*\b"
STYLE_PATTERN = r"^[A-Z0-9]{1,9}$"
PRODUCT_TAIL_PATTERN = r"\b[A-Z][A-Z0-9]+$"
NUMBER_PATTERN = r"(\d+\.?\d*)"
DIGITS_PATTERN = r"(\d+)"
UPC_PATTERN = r"(4\d{11})"
SUPPLIER_IN_PARENS = r"\(([^)]+)\)$"
MEMO_STOP_PHRASES = (
    "NOTE THE FOLLOWING CHANGES",
    "HAVE BEEN ADDED TO THE LINE",
    "AGAIN FOR SALE",
)
# Reply bodies are cut at the quoted-mail marker; the real marker lives in
# private config, so this is a parameter.
MAIL_MARKER = "From:"
# Order-type codes shown to suppliers (unmapped codes become null).
TYPE_NAMES = (("C", "Special"), ("S", "Stock"), ("P", "P"), ("D", "D"))
# Known spelling fixes in vendor long names: (as written, as meant).
LONGNAME_FIXES = ()
# Photo links are built from the lower-cased item code.
PHOTO_BASE = "https://images.example/catalog/product"
# Customer sheet exports: rows to skip above the header, header renames.
SHEET_TEMPLATES = {
    "CL7158": (23, {"STYLE #": "Product", "QTY": "Qty", "Unit Total": "Unit Cost", "Total Cost": "Ext Cost"}),
    "PA6502": (0, {"Item": "Product", "Unit Price": "Unit Cost", "Total": "Ext Cost"}),
    "FL4494": (15, {"SKU Number  Description": "Description", "Vendor Part No.": "Product",
                    "Qty Ord/ Pcs": "Qty", "Unit Retail": "Retail", "Extended Cost": "Ext Cost"}),
    "SALEREP": (0, {}),
}
# Extracted-table layouts of customer order documents: header names.
LAYOUT_FL2658 = {"ITEM NO.": "Product", "QTY": "Qty", "Unit Price": "Unit Cost", "SubTotal": "Ext Cost"}
LAYOUT_PA1683 = ("SUPPLIER #", "QTY", "PRICE/UN", "AMOUNT")
LAYOUT_AZ1239 = {"Vendor Part No": "Product", "Order Cost": "Unit Cost"}
AZ1239_NOISE = "EaOnly|,"
LAYOUT_NV0356 = {"Style description / Vendor style": "Product", "Extended cost": "Ext Cost",
                 "Unit cost": "Unit Cost", "Ordered qty": "Qty"}
LAYOUT_NV0356_PRODUCT_ALT = "Style description / Vendor style Expected rec date"
LAYOUT_NV0356_COLUMNS = ("Product", "Qty", "Unit Cost", "Ext Cost", "Unit retail", "UPC")
LAYOUT_MA0603 = {"description": "DESCRIPTION", "retail_marker": "UNIT RETAIL", "barcode": "UPC-A/EAN"}
# FL4494 documents: header = column name without digits, dots and slashes + first row.
LAYOUT_FL4494_NOISE = r"[.0-9/]"
LAYOUT_FL4494_TEXT = "Description"
LAYOUT_FL4494 = {"Unit Retail": "Unit Retail", "Unit Cost": "Unit Cost", "Ord Pcs": "Qty", "Extended Cost": "Ext Cost"}
# Office price sheets: renamed and dropped headers.
OFFICE_RENAMES = {"NW/GW LBS": "NW/GW"}
OFFICE_DROP = "IN/OUT/   PACK PCS"
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class ShippingParams:
    as_of: _dt.date = AS_OF
    missing_share: float = MISSING_SHARE
    late_days: int = LATE_DAYS
    lead_days: int = DEADLINE_LEAD_DAYS
    alarm_days: int = DATE_ALARM_DAYS
    reset_days: int = DATE_RESET_DAYS
    stock_reset_share: float = STOCK_RESET_SHARE


@dataclass(frozen=True)
class OrderParams:
    ticket: str = TICKET
    discount: str = DISCOUNT
    rounding_error: str = ROUNDING_ERROR
