"""Open purchase orders, late suppliers, reminders and replies (C1-C5, C19,
C20, B7-B9, G1, G11, G12, G14, G15, J13, J14, A17, A18).

Plan shape at scale: the order lines are read once. The tracking summary
aggregates both outcomes of the whole-table date alarm (G11); the row-level jobs
write the kept lines, observe the alarm on that write, and work on what they
wrote (``open_orders_once``). The contact list joins
on SUPPLR (AQE turns it into a broadcast only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``); the global date-alarm flag is a
scalar subquery. Per-supplier and per-contact results are
``groupBy`` with partial (map-side) aggregation, so a supplier holding a third
of all lines is pre-aggregated in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.rules import any_flag, flag, fresh_key, ne, parse_date, ratio, truthy
from ..params import TYPE_NAMES, ShippingParams
from ..session import by_whole_row, ensure_checkpoint_dir, written

LINE_COLS = ["PURORD", "SUPPLR", "PRODCT", "ORDQTY", "OUTQTY", "CONDAT", "NEWCONDAT",
             "DATEDFF", "TYPE", "PCTSHIP"]


def deadline(p: ShippingParams):
    """Month end of as_of + lead days (batch scripts)."""
    return S.month_end(p.as_of, p.lead_days)


def web_deadline(p: ShippingParams):
    """Month end of as_of (web views)."""
    return S.month_end(p.as_of, 0)


def clean_lines(lines: DataFrame) -> DataFrame:
    """Blanks out of supplier codes, whole ordered quantity, dates parsed,
    remaining share ``PCTSHIP = OUTQTY / ORDQTY``."""
    ordqty = F.col("ORDQTY").cast("int")
    return lines.select(
        "PURORD",
        S.remove_text("SUPPLR", " ").alias("SUPPLR"),
        "PRODCT",
        ordqty.alias("ORDQTY"),
        F.col("OUTQTY").cast("bigint").alias("OUTQTY"),
        "INTQTY",
        parse_date("CONDAT").alias("CONDAT"),
        parse_date("NEWCONDAT").alias("NEWCONDAT"),
        "DATEDFF",
        "TYPE",
        ratio("OUTQTY", ordqty).alias("PCTSHIP"),
    )


def missing_condition(p: ShippingParams):
    return truthy(F.col("PCTSHIP") < F.lit(p.missing_share)) & truthy(F.col("INTQTY") == 0)


def due_lines(lines: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """Cleaned lines due by the deadline."""
    return clean_lines(lines).where(F.col("CONDAT") <= deadline(p))


def missing_items(lines: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """Missing-item report (B8): almost nothing left to ship and nothing in transit."""
    return (due_lines(lines, p).where(missing_condition(p))
            .select("PURORD", "SUPPLR", "PRODCT", "ORDQTY", "OUTQTY", "CONDAT"))


def kept_lines(lines: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """Due lines without the missing items (complement of B8)."""
    return due_lines(lines, p).where(~missing_condition(p))


def correct_dates(kept: DataFrame, p: ShippingParams = ShippingParams(),
                  keep_before: bool = False) -> DataFrame:
    """If any line is moved more than ``alarm_days``, every line moved more
    than ``reset_days`` gets its original date back.

    The whole-table condition is a scalar subquery (``DataFrame.scalar``): one
    boolean computed once and read by every task, no join.
    """
    alarm = kept.agg(any_flag(F.col("DATEDFF") > p.alarm_days)).scalar()
    reset = alarm & truthy(F.col("DATEDFF") > p.reset_days)
    out = kept
    if keep_before:
        out = out.withColumns({"NEWCONDAT_BEFORE": F.col("NEWCONDAT"), "ALARM": alarm})
    return out.withColumn("NEWCONDAT", F.when(reset, F.col("CONDAT")).otherwise(F.col("NEWCONDAT")))


def date_correction(lines: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """Lines whose contract date was reset by G11 (or would be, if the alarm is off)."""
    out = correct_dates(kept_lines(lines, p), p, keep_before=True)
    return out.where(F.col("DATEDFF") > p.reset_days).select(
        "PURORD", "SUPPLR", "PRODCT", "DATEDFF", "CONDAT", "NEWCONDAT_BEFORE", "NEWCONDAT", "ALARM")


def kept_once(lines: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """B7 + B8 + G11 in one read of the lines: the kept lines are written to the
    shared folder, the alarm is observed on that write, and the dates are
    corrected on what was written. Equal to ``correct_dates(kept_lines(lines))``."""
    seen = Observation()
    kept = kept_lines(lines, p).observe(seen, any_flag(F.col("DATEDFF") > p.alarm_days).alias("alarm"))
    kept = written(kept, "kept")
    if not seen.get.get("alarm"):
        return kept
    reset = truthy(F.col("DATEDFF") > p.reset_days)
    return kept.withColumn("NEWCONDAT", F.when(reset, F.col("CONDAT")).otherwise(F.col("NEWCONDAT")))


def open_orders_once(lines: DataFrame, contacts: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """C1 with one read of the lines; writes them once, so that every report
    built on the result reads the kept lines only."""
    return with_contacts(kept_once(lines, p), contacts)


def open_orders(lines: DataFrame, contacts: DataFrame,
                p: ShippingParams = ShippingParams()) -> DataFrame:
    """Open order lines due by the deadline, cleaned, with supplier e-mail
    (one plan without an action; the alarm reads the lines a second time)."""
    return with_contacts(correct_dates(kept_lines(lines, p), p), contacts)


def with_contacts(kept: DataFrame, contacts: DataFrame) -> DataFrame:
    """The kept lines with their supplier's e-mail."""
    return kept.join(contacts.select("SUPPLR", "EMAIL"), "SUPPLR", "left").select(*LINE_COLS, "EMAIL")


def split_orders(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stock orders of 'C' suppliers, everything else that is stock or special)."""
    first = S.first_chars("SUPPLR", 1)
    stock = truthy(F.col("TYPE") == "S")
    special = truthy(F.col("TYPE") == "C")
    stock_c = orders.where(truthy(first == "C") & stock)
    rest = orders.where((ne(first, F.lit("C")) & stock) | special)
    return stock_c, rest


def flag_lines(orders: DataFrame, p: ShippingParams = ShippingParams(),
               reset_stock: bool = True) -> DataFrame:
    """Per-line LATE / ATTN / Z_ITEMS flags.

    Z_ITEMS is decided before the stock reset of ATTN; it is 1 or null.
    """
    newdate = F.col("NEWCONDAT")
    attn = truthy(newdate < S.days_before(p.as_of, p.late_days))
    late = truthy(newdate < F.lit(p.as_of))
    z = F.when(truthy(F.col("TYPE") == "C") & attn, F.lit(1))
    if reset_stock:
        reset = truthy(F.col("TYPE") == "S") & truthy(F.col("PCTSHIP") < F.lit(p.stock_reset_share))
        attn = attn & ~reset
    return orders.withColumns({
        "LATE": F.when(late, 1).otherwise(0),
        "ATTN": F.when(attn, 1).otherwise(0),
        "Z_ITEMS": z,
    })


def summarise_tracking(flagged: DataFrame, with_email: bool = True) -> DataFrame:
    """G1: one row per supplier (null supplier dropped, as pandas groupby does)."""
    aggs = []
    if with_email:
        aggs.append(F.min("EMAIL").alias("EMAIL"))
    aggs += [
        F.min("NEWCONDAT").alias("NEWCONDAT"),
        F.sum("LATE").cast("bigint").alias("LATE"),
        F.max("ATTN").alias("ATTN"),
        any_flag(F.col("Z_ITEMS") == 1).cast("int").alias("Z_ITEMS"),
    ]
    return flagged.where(F.col("SUPPLR").isNotNull()).groupBy("SUPPLR").agg(*aggs)


def tracking_summary(orders: DataFrame, p: ShippingParams = ShippingParams(),
                     reset_stock: bool = True) -> DataFrame:
    """Supplier tracking sheet from the open orders (the B9 'rest' half)."""
    return summarise_tracking(flag_lines(orders, p, reset_stock))


def tracking_summary_from_lines(lines: DataFrame, contacts: DataFrame,
                                p: ShippingParams = ShippingParams(), reset_stock: bool = True) -> DataFrame:
    """C1 + B9 + C2 in one read of the order lines: the same result as
    ``tracking_summary(split_orders(open_orders(lines, contacts))[1])``.

    The whole-table date alarm (G11) decides which contract date every line
    uses, so the per-supplier figures are aggregated for both outcomes in one
    pass, with the alarm's per-supplier part alongside; that per-supplier
    table is checkpointed, and the alarm is a scalar subquery over it that
    picks the figures.
    Contacts are joined after the aggregation (one row per supplier): e-mail
    is their smallest address, and the late count is multiplied by the
    number of contact rows, as the row-level join would.
    """
    kept = kept_lines(lines, p)
    first = S.first_chars("SUPPLR", 1)
    in_rest = (ne(first, F.lit("C")) & truthy(F.col("TYPE") == "S")) | truthy(F.col("TYPE") == "C")
    lateline = S.days_before(p.as_of, p.late_days)
    corrected = F.when(truthy(F.col("DATEDFF") > p.reset_days), F.col("CONDAT")).otherwise(F.col("NEWCONDAT"))

    def figures(newdate, tag):
        attn = truthy(newdate < lateline)
        z = truthy(F.col("TYPE") == "C") & attn
        if reset_stock:
            attn = attn & ~(truthy(F.col("TYPE") == "S") & truthy(F.col("PCTSHIP") < F.lit(p.stock_reset_share)))
        return [F.min(F.when(in_rest, newdate)).alias(f"_d{tag}"),
                F.count_if(in_rest & truthy(newdate < F.lit(p.as_of))).alias(f"_l{tag}"),
                F.max(F.when(in_rest, F.when(attn, 1).otherwise(0))).alias(f"_a{tag}"),
                any_flag(in_rest & z).cast("int").alias(f"_z{tag}")]

    per = kept.groupBy("SUPPLR").agg(any_flag(F.col("DATEDFF") > p.alarm_days).alias("_alarm"),
                                     F.count_if(in_rest).alias("_rest"),
                                     *figures(corrected, "c"), *figures(F.col("NEWCONDAT"), "p"))
    # the per-supplier table (one row per supplier) is written once to the
    # shared checkpoint folder: the alarm and the figures then read it, and
    # the order lines are read a single time
    ensure_checkpoint_dir(per.sparkSession)
    per = per.checkpoint(eager=True)
    alarm = per.agg(any_flag(F.col("_alarm"))).scalar()
    per = per.where(F.col("SUPPLR").isNotNull() & (F.col("_rest") > 0))
    cc = contacts.groupBy("SUPPLR").agg(F.min("EMAIL").alias("EMAIL"), F.count(F.lit(1)).alias("_c"))
    out = per.join(cc, "SUPPLR", "left")

    def pick(name):
        return F.when(alarm, F.col(f"_{name}c")).otherwise(F.col(f"_{name}p"))
    return out.select("SUPPLR", "EMAIL", pick("d").alias("NEWCONDAT"),
                      (pick("l") * F.coalesce(F.col("_c"), F.lit(1))).cast("bigint").alias("LATE"),
                      pick("a").alias("ATTN"), pick("z").alias("Z_ITEMS"))


def late_orders(orders: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """Late lines (sort by SUPPLR, NEWCONDAT at the sink)."""
    return flag_lines(orders, p).where(F.col("LATE") == 1)


def late_reminders(orders: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """Late lines of suppliers that need attention, with their contact."""
    flagged = flag_lines(orders, p)
    attention = summarise_tracking(flagged).where(F.col("ATTN") > 0).select("SUPPLR")
    return (flagged.join(fresh_key(attention, "SUPPLR"), "SUPPLR", "left_semi")
            .where(F.col("NEWCONDAT") < F.lit(p.as_of))
            .select("PURORD", "SUPPLR", "PRODCT", "ORDQTY", "OUTQTY", "CONDAT", "NEWCONDAT",
                    "TYPE", "LATE", "EMAIL"))


def contact_columns(orders: DataFrame) -> DataFrame:
    """Per contact, whether OUTQTY and NEWCONDAT carry information."""
    return (orders.where(F.col("EMAIL").isNotNull()).groupBy("EMAIL").agg(
        F.count(F.lit(1)).alias("N_ROWS"),
        any_flag(ne("ORDQTY", "OUTQTY")).alias("SHOW_OUTQTY"),
        any_flag(ne("CONDAT", "NEWCONDAT")).alias("SHOW_NEWCONDAT"),
    ))


def format_table(df: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """B3 + F15 + F25: supplier-facing names, order-type names, past-due mark."""
    renames = {"SUPPLR": "Supplier", "PURORD": "PO#", "PRODCT": "Item#", "ORDQTY": "ORDERED"}
    out = df.withColumn("TYPE", S.map_codes("TYPE", TYPE_NAMES))
    out = out.withColumn("PAST_DUE", truthy(F.col("CONDAT") <= F.lit(p.as_of)))
    return out.withColumnsRenamed(renames)


def contact_reminders(orders: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """C4: reminder rows per contact; OUTQTY / NEWCONDAT are null where the
    reference drops the column for that contact."""
    cols = contact_columns(orders).drop("N_ROWS")
    rows = orders.where(F.col("EMAIL").isNotNull()).join(fresh_key(cols, "EMAIL"), "EMAIL", "inner").select(
        "EMAIL", "PURORD", "SUPPLR", "PRODCT", "ORDQTY",
        F.when(F.col("SHOW_OUTQTY"), F.col("OUTQTY")).alias("OUTQTY"),
        "CONDAT",
        F.when(F.col("SHOW_NEWCONDAT"), F.col("NEWCONDAT")).alias("NEWCONDAT"),
        "TYPE")
    return format_table(rows, p)


def missing_contacts(orders: DataFrame) -> DataFrame:
    """Lines that cannot be sent because the supplier has no e-mail."""
    return orders.where(F.col("EMAIL").isNull())


def quality_counts(lines: DataFrame, contacts: DataFrame,
                   p: ShippingParams = ShippingParams()) -> DataFrame:
    """Data-quality rules of the shipping run in one scan."""
    # one row per supplier, so that a second contact does not count a line twice
    mail = contacts.groupBy("SUPPLR").agg(F.max("EMAIL").alias("EMAIL"))
    due = due_lines(lines, p).join(fresh_key(mail, "SUPPLR"), "SUPPLR", "left")
    miss = missing_condition(p)
    counts = due.agg(
        F.count_if(~miss & F.col("EMAIL").isNull()).alias("missing_email"),
        F.count_if(miss).alias("missing_item"),
        F.count_if(~miss & truthy(F.col("DATEDFF") > p.alarm_days)).alias("date_entry"),
    )
    return counts.select(F.expr(
        "stack(3, 'missing_email', missing_email, missing_email > 1, "
        "'missing_item', missing_item, missing_item > 0, "
        "'date_entry', date_entry, date_entry > 0) as (rule, n_rows, failed)"))


# --- replies ---------------------------------------------------------------

def read_messages(messages: DataFrame, since) -> DataFrame:
    """B18 + F24 + F10/F11: messages after ``since`` with FCR flag and cut body.
    ``attachment`` is one name or an array of names, any of which may say FCR."""
    names = F.col("attachment")
    fcr = F.exists(names, lambda n: n.contains("FCR")) if messages.schema["attachment"].dataType.typeName() == "array" \
        else names.contains("FCR")
    return messages.where(F.col("receive") > F.lit(since)).select(
        "conv_id", "turn", "sender",
        F.when(F.instr(F.col("email"), "@") > 0, F.col("email")).otherwise(F.col("sender")).alias("email"),
        "receive",
        F.when(truthy(fcr), 1).otherwise(0).alias("FCR"),
        S.text_before("body").alias("body"),
    )


#: Text of a sender in one row; more makes further rows.
PART_BYTES = 1 << 26
#: Conversations whose sizes are summed by one task for a sender of several parts.
SLICE_CONVERSATIONS = 100_000


def _ordered(parts, text: str):
    """Texts of a group joined with '-' in the order of the other fields."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*parts, text))), lambda x: x[text]), "-")


def replies(messages: DataFrame, since, part_bytes: int = PART_BYTES,
            slice_conversations: int = SLICE_CONVERSATIONS) -> DataFrame:
    """Per (lower-cased) sender: last receive date, FCR count, bodies
    joined with '-' in mailbox order (conv_id, turn).

    ``part`` is 0 but for senders with more than ``part_bytes`` of text: their
    bodies come in several rows, part after part, each of about that size, so
    no row and no task holds a whole sender. Joined with '-' in order, the
    parts are the whole text (``write_replies`` writes them so).
    """
    msgs = read_messages(messages, since).withColumn("email", F.lower("email"))
    size = F.coalesce(F.octet_length("body"), F.lit(0)) + 1
    per_sender = msgs.groupBy("email").agg(F.max("receive").alias("receive"), F.sum("FCR").cast("bigint").alias("FCR"),
                                           F.sum(size).alias("_bytes"))
    long = per_sender.where(F.col("_bytes") > part_bytes).withColumnRenamed("email", "_email")
    whose = F.col("email").eqNullSafe(F.col("_email"))
    # bodies are joined per conversation first, then conversations per sender
    short = msgs.join(long.select("_email"), whose, "left_anti")
    per_conv = short.groupBy("email", "conv_id").agg(
        F.max("receive").alias("receive"), F.sum("FCR").alias("FCR"), F.count("body").alias("_n"), _ordered(["turn"], "body").alias("_part"))
    per_conv = per_conv.withColumn("_part", F.when(F.col("_n") > 0, F.col("_part")))
    whole = per_conv.groupBy("email").agg(F.max("receive").alias("receive"), F.sum("FCR").cast("bigint").alias("FCR"),
                                          _ordered(["conv_id"], "_part").alias("body"))
    whole = whole.select("email", F.lit(0).alias("part"), "receive", "FCR", "body")
    of_long = msgs.drop("receive", "FCR").join(long.drop("_bytes"), whose).drop("_email")
    return whole.unionByName(_reply_parts(of_long, size, part_bytes, slice_conversations))


def _reply_parts(msgs: DataFrame, size, part_bytes: int, slice_conversations: int) -> DataFrame:
    """Messages of long senders, a part for each ``part_bytes`` that begin in it.

    A message's part follows from the bytes before it: those of the slices of
    conversations before (one small row per sender and slice), and those before
    it in its own slice.
    """
    m = msgs.withColumns({"_size": size, "_sl": F.floor(F.col("conv_id") / slice_conversations)})
    inside = Window.partitionBy("email", "_sl").orderBy("conv_id", "turn").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_e").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    per = m.groupBy(F.col("email").alias("_e"), F.col("_sl").alias("_s")).agg(F.sum("_size").alias("_n"))
    per = per.select("_e", "_s", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    m = m.withColumn("_own", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    m = m.join(per, F.col("email").eqNullSafe(F.col("_e")) & F.col("_sl").eqNullSafe(F.col("_s")))
    part = F.floor((F.col("_before") + F.col("_own")) / part_bytes).cast("int")
    body = F.when(F.count("body") > 0, _ordered(["conv_id", "turn"], "body"))  # a part without any text is null
    return m.groupBy("email", part.alias("part")).agg(F.max("receive").alias("receive"), F.max("FCR").alias("FCR"), body.alias("body"))


def mark_replied(orders: DataFrame, replied: DataFrame) -> DataFrame:
    """REPLY = the line's contact is among the repliers."""
    # a computed key: AQE can split a hot contact's lines
    keys = replied.select(F.concat("email", F.lit("")).alias("_reply_email")).distinct()
    return (orders.join(keys, F.lower(F.col("EMAIL")) == F.col("_reply_email"), "left")
            .withColumn("REPLY", F.col("_reply_email").isNotNull()).drop("_reply_email"))


# --- web views -------------------------------------------------------------

def web_lines(lines: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """Raw tracking rows with parsed dates, due by the month end of as_of."""
    return lines.withColumns({
        "CONDAT": parse_date("CONDAT"), "NEWCONDAT": parse_date("NEWCONDAT"),
    }).where(F.col("CONDAT") <= web_deadline(p))


def web_tracking(lines: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """Web tracking summary (no e-mail, no stock reset, codes not cleaned)."""
    return summarise_tracking(flag_lines(web_lines(lines, p), p, reset_stock=False),
                              with_email=False)


def web_supplier_tracking(lines: DataFrame, suppliers: DataFrame | None = None,
                          p: ShippingParams = ShippingParams()) -> DataFrame:
    """C20: per-line flags for the requested suppliers (all if None)."""
    if suppliers is not None:
        lines = lines.join(fresh_key(suppliers.select("SUPPLR").distinct(), "SUPPLR"), "SUPPLR", "left_semi")
    out = flag_lines(web_lines(lines, p), p, reset_stock=False)
    return out.withColumn("Z_ITEMS", F.coalesce(F.col("Z_ITEMS"), F.lit(0)))


def shipments(lines: DataFrame, p: ShippingParams = ShippingParams()) -> DataFrame:
    """Tracking rows in the web model's field names."""
    return lines.select(
        F.col("PURORD").alias("purord"), F.col("SUPPLR").alias("supplr"),
        F.col("PRODCT").alias("item"), F.col("ORDQTY").cast("int").alias("ordqty"),
        F.col("OUTQTY").cast("int").alias("outqty"),
        parse_date("CONDAT").alias("condat"), parse_date("NEWCONDAT").alias("newdate"),
        F.col("TYPE").alias("type"),
        flag(parse_date("NEWCONDAT") < F.lit(p.as_of)).alias("late"))


def shipments_raw(lines: DataFrame) -> DataFrame:
    """The three listed shipment fields."""
    return lines.select(F.col("PURORD").alias("purord"), F.col("SUPPLR").alias("supplr"),
                        F.col("PRODCT").alias("item"))


def records(rows: DataFrame) -> DataFrame:
    """Each row as one JSON record (null fields included)."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def shipping_grouped(ship: DataFrame) -> DataFrame:
    """Browser grouping: earliest contract date and late count per supplier."""
    return ship.groupBy("supplr").agg(F.min("condat").alias("condat"),
                                      F.sum("late").cast("bigint").alias("late"))


def rows_to_insert(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows whose whole value is not stored yet (once each).

    Incoming and stored rows are tagged, united and grouped on every column
    (grouping treats nulls as equal, so the test is null-safe), in the pieces
    of ``by_whole_row``.
    """
    cols = existing.columns
    tagged = by_whole_row(existing.select(*cols)).withColumn("_old", F.lit(1)).unionByName(
        by_whole_row(incoming.select(*cols)).withColumn("_old", F.lit(0)))
    return (tagged.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.max("_old").alias("_old"))
            .where(F.col("_old") == 0).select(*cols))


def insert_absent(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """The table after insert-if-absent on all columns (stored rows are
    kept as they are; ``sinks.append_rows`` writes only ``rows_to_insert``)."""
    return existing.unionByName(rows_to_insert(incoming, existing))
