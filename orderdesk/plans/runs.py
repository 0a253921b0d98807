"""End-to-end runs.

A run computes its shared intermediate once, cuts its lineage with
``checkpoint()`` (written to the shared folder named by
``spark.checkpoint.dir``, so a lost executor never forces a recompute from
the raw tables), then writes every report of the run from it. Each writer is
one distributed job; nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import orders as O
from ..operators import pricing as PR
from ..operators import shipping as SH
from ..params import SEND_DATE, OrderParams, ShippingParams
from ..session import ensure_checkpoint_dir
from ..sources import sinks


def _cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shipping_run(spark: SparkSession, lines: DataFrame, contacts: DataFrame, messages: DataFrame,
                 out_dir: str, p: ShippingParams = ShippingParams(), since=SEND_DATE) -> dict:
    """L1: open orders -> (stock C / rest) -> reminders, tracking sheet, late
    list, late reminders, replies, orders with reply flag, quality counts."""
    orders = _cut(SH.open_orders(lines, contacts, p))
    stock_c, rest = SH.split_orders(orders)
    rep = SH.replies(messages, since)
    outputs = {
        "reminders": (SH.contact_reminders(rest, p), ["Supplier", "Item#"]),
        "reminders_stock_c": (SH.contact_reminders(stock_c, p), ["Supplier", "Item#"]),
        "missing_contacts": (SH.missing_contacts(rest), ["SUPPLR", "PRODCT"]),
        "tracking": (SH.tracking_summary(rest, p), ["SUPPLR"]),
        "late_orders": (SH.late_orders(rest, p), ["SUPPLR", "NEWCONDAT"]),
        "late_reminders": (SH.late_reminders(rest, p), ["SUPPLR", "NEWCONDAT"]),
        "replies": (rep, ["email"]),
        "tracking_replies": (SH.mark_replied(rest, rep), ["SUPPLR"]),
        "quality": (SH.quality_counts(lines, contacts, p), ["rule"]),
    }
    for name, (df, order) in outputs.items():
        sinks.write_csv(df, f"{out_dir}/{name}", order)
    return {k: f"{out_dir}/{k}" for k in outputs}


def pricing_run(spark: SparkSession, items: DataFrame, contacts: DataFrame, quotes: DataFrame,
                out_dir: str, covered: DataFrame | None = None) -> dict:
    """L2: price requests (one folder per vendor), cover sheets for the
    worklist (one folder per vendor) with their flags, inactive covers. The
    worklist is what ``out_dir`` does not hold yet: a second run writes the
    vendors added since and leaves the sheets of the others (``covered`` names
    further vendors that need none)."""
    fx = PR.fx_table(spark)
    requests = PR.price_requests(items, contacts, fx)
    sinks.write_per_vendor(requests, f"{out_dir}/requests", order=["ROW_NO"])
    done = sinks.vendor_partitions(spark, f"{out_dir}/covers")
    done = done if covered is None else done.union(covered.select("SUPPLR"))
    cover = _cut(PR.cover_sheet(items, quotes, PR.cover_worklist(contacts, done)))
    sinks.write_per_vendor(cover, f"{out_dir}/covers", order=["SORT_KEY", "PRODCT"])
    sinks.write_per_vendor(PR.cover_flags(cover, PR.reviewed_vendors(contacts)), f"{out_dir}/cover_flags")
    sinks.write_per_vendor(PR.inactive_cover(items, contacts), f"{out_dir}/inactive_covers", order=["PRODCT"])
    return {k: f"{out_dir}/{k}" for k in ("requests", "covers", "cover_flags", "inactive_covers")}


def orders_run(spark: SparkSession, lines: DataFrame, inventory: DataFrame, contacts: DataFrame,
               out_dir: str, p: OrderParams = OrderParams()) -> dict:
    """L3: checked order lines, unknown items, over-available lines, order
    totals and supplier quote requests."""
    priced = _cut(O.price_lines(lines, inventory, p))
    outputs = {
        "checked": (O.outlet(priced), ["PO", "Product"]),
        "unknown_items": (O.outlet(O.unknown_items(lines, inventory)), ["PO", "Product"]),
        "over_available": (O.outlet(O.over_available(priced)), ["PO", "Product"]),
        "totals": (O.order_totals(priced), ["PO"]),
        "quotes": (O.outlet(O.quote_requests(priced, contacts)), ["EMAIL", "Product"]),
    }
    for name, (df, order) in outputs.items():
        sinks.write_csv(df, f"{out_dir}/{name}", order)
    return {k: f"{out_dir}/{k}" for k in outputs}
