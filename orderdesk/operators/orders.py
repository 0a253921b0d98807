"""Customer orders: price check against stock and case packs, order totals,
supplier quote requests, dummy-vs-customer confirmations (C11-C13, G6, G8,
F21, F22, J3, J8, J12, J15, B17, U1).

Money stays DECIMAL through every rule and total; ``outlet`` casts it to
DOUBLE for delivery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions import scalars as S
from ..functions.rules import dec, flag, ne, truthy
from ..params import CUSTOMER_CODE, OrderParams
from ..session import pieces


def outlet(df: DataFrame) -> DataFrame:
    """DECIMAL money columns to DOUBLE (the last step before delivery)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def restrict_items(inventory: DataFrame, lines: DataFrame) -> DataFrame:
    """Inventory rows of the items ordered (the reference's IN-list)."""
    return inventory.join(lines.select("Product").distinct(), inventory["Item"] == F.col("Product"), "left_semi")


def join_inventory(lines: DataFrame, inventory: DataFrame) -> DataFrame:
    """Order lines left-joined with inventory (Product = Item)."""
    return lines.join(inventory, lines["Product"] == inventory["Item"], "left")


def unit_price(case_price, split_price, cases, p: OrderParams = OrderParams(), ticket=None, discount=None):
    """case price less discount plus ticket when whole cases are ordered,
    else split price plus ticket; plus the rounding epsilon; half-up to cents.
    ``ticket`` and ``discount`` are columns where they differ by order set."""
    ticket = dec(p.ticket) if ticket is None else ticket
    discount = dec(p.discount) if discount is None else discount
    eps = dec(p.rounding_error)
    by_case = F.col(case_price) * (F.lit(1).cast("decimal(1,0)") - discount) + ticket
    by_split = F.col(split_price) + ticket
    return F.round(F.when(truthy(cases > 0), by_case).otherwise(by_split) + eps, 2)


def with_terms(lines: DataFrame, terms: DataFrame | None, p: OrderParams = OrderParams(),
               keys: tuple[str, ...] = ("Customer",)) -> DataFrame:
    """TICKET and DISCOUNT of each line's order set: ``terms`` has one row per
    ``keys``; sets without a row (or with a null term) take the defaults of ``p``."""
    if terms is None:
        return lines.withColumns({"TICKET": dec(p.ticket), "DISCOUNT": dec(p.discount)})
    set_terms = terms.select(*keys, F.col("TICKET").alias("_t"), F.col("DISCOUNT").alias("_d"))
    money = "decimal(12,4)"
    return lines.join(set_terms, list(keys), "left").withColumns({
        "TICKET": F.coalesce(F.col("_t").cast(money), dec(p.ticket)),
        "DISCOUNT": F.coalesce(F.col("_d").cast(money), dec(p.discount))}).drop("_t", "_d")


def price_lines(lines: DataFrame, inventory: DataFrame, p: OrderParams = OrderParams(),
                terms: DataFrame | None = None, keys: tuple[str, ...] = ("Customer",)) -> DataFrame:
    """C11: known order lines with case count, computed price and mismatch
    flag. ``terms`` gives ticket and discount per order set (``with_terms``)."""
    j = join_inventory(with_terms(lines, terms, p, keys), inventory).where(F.col("Status").isNotNull())
    caseflag = F.try_mod(F.col("Qty"), F.col("CaseQty"))
    cases = F.when(caseflag == 0, F.floor(F.try_divide(F.col("Qty"), F.col("CaseQty"))))
    j = j.withColumn("NO_CASE", cases.cast("bigint"))
    j = j.withColumn("PRICE", unit_price("CasePrice", "SplitPrice", F.col("NO_CASE"), p, F.col("TICKET"), F.col("DISCOUNT")))
    return j.withColumn("FLAG", F.when(ne("PRICE", "Unit_Cost"), "!").otherwise("")).drop("Item", "DISCOUNT")


def unknown_items(lines: DataFrame, inventory: DataFrame) -> DataFrame:
    """Order lines whose item is unknown or has no status."""
    return join_inventory(lines, inventory).where(F.col("Status").isNull())


def over_available(priced: DataFrame) -> DataFrame:
    """Lines asking for more than is available."""
    return priced.where(F.col("Qty") > F.col("NETAVAIL"))


def order_totals(priced: DataFrame) -> DataFrame:
    """Per order, sum of extended cost vs sum of price x quantity."""
    per = priced.groupBy("PO").agg(
        F.round(F.sum("Ext_Cost"), 2).alias("EXT_TOTAL"),
        F.round(F.sum(F.col("PRICE") * F.col("Qty")), 2).alias("PRICED_TOTAL"),
        F.count_if(F.col("FLAG") == "!").alias("N_FLAGGED"))
    return per.select("PO", F.col("EXT_TOTAL").cast("double").alias("EXT_TOTAL"),
                      F.col("PRICED_TOTAL").cast("double").alias("PRICED_TOTAL"), "N_FLAGGED",
                      (F.col("EXT_TOTAL") == F.col("PRICED_TOTAL")).alias("EQUAL"))


def quote_requests(priced: DataFrame, contacts: DataFrame) -> DataFrame:
    """C12: 'Z' items of the checked orders, supplier code from the supplier
    text, contact e-mail (null = no contact), quantities of 1 or less blank."""
    q = priced.where(S.first_chars("Product_long", 1) == "Z").withColumn(
        "SUPPLR", S.supplier_in_parens("Supplier"))
    j = q.join(contacts.select("SUPPLR", "EMAIL"), "SUPPLR", "left")
    return j.select("EMAIL", "SUPPLR", "Customer", "Product", "Product_long",
                    F.when(~truthy(F.col("Qty") <= 1), F.col("Qty").cast("string")).alias("QTY"),
                    "Ship_Date", "Unit_Cost")


def missing_contact(quotes: DataFrame) -> DataFrame:
    """The quote request rows that reach nobody (e-mail null or blank)."""
    return quotes.where(F.trim(F.coalesce("EMAIL", F.lit(""))) == "")


def union_orders(*frames: DataFrame) -> DataFrame:
    """Union by column name; missing columns are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dummy_check(customer: DataFrame, dummy: DataFrame, code: str = CUSTOMER_CODE,
                codes: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Customer confirmations (Y-prefixed items, customer prefix removed)
    summed per product, full-joined with the dummy confirmation; FLAG=1 where
    quantities differ or one side is missing.

    ``keys`` (present on both sides) keep orders apart: the comparison is per
    keys and product. ``codes`` (Customer, CODE; one row per customer) looks
    each customer's code up instead of the one ``code``; a customer without a
    code keeps its products as written.
    """
    by = [*keys, "Product"]
    cust = customer.where(S.first_chars("Product", 1) == "Y")
    if codes is None:
        cust = cust.withColumn("Product", S.remove_text("Product", "Y" + code))
    else:
        cust = cust.join(codes.select("Customer", F.col("CODE").alias("_code")), "Customer", "left").withColumn(
            "Product", F.when(F.col("_code").isNull(), F.col("Product")).otherwise(
                F.replace(F.col("Product"), F.concat(F.lit("Y"), F.col("_code")), F.lit(""))))
    cust, dummy = (df.where(F.col("Product").isNotNull()) for df in (cust, dummy))
    if keys:
        # an order hardly repeats a product: summing before the shuffle would save none and hold every group of a task
        cust, dummy = (df.repartition(pieces(df.sparkSession), *by) for df in (cust, dummy))
    c = cust.groupBy(*by).agg(
        F.coalesce(F.sum("Ordered"), F.lit(0)).cast("bigint").alias("Ordered"))
    d = dummy.groupBy(*by).agg(
        F.coalesce(F.sum("Dummy_Qty"), F.lit(0)).cast("bigint").alias("Dummy_Qty"))
    j = d.join(c, by, "full")
    return j.withColumn("FLAG", flag(ne("Ordered", "Dummy_Qty")))
