"""Secret scan by corpus-wide ownership frequency (DataFrame functions only).

Three base kinds of secrets and a kind of other token-like strings are found
per text. The hash of every value is counted over the whole corpus by distinct
repositories and owners: a value held by many owners is a widely copied
example, one held by few is owner-specific and looks live. Base spans are
always reported; other strings only where their value looks live.

Counting aggregates before each shuffle, so a value copied into a third of all
documents is a few rows per task. Texts never leave the scan: only spans are
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialise, text_of

KINDS = ("assign", "access", "hex", "other")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Provider prefixes, signed tokens, key blocks to their END (without one, to the end of the long lines), and long strings mixing digits with both cases.
OTHER = (r"(?:ghp|gho|ghs|glpat|xox[abps]|sk_live|rk_live|pk_live|sk|npm|hf)[_-][A-Za-z0-9_-]{16,}"
         r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"
         r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
         r"(?:(?:[^-]|-(?!----))*+-----END [A-Z ]{0,20}PRIVATE KEY-----|(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{24,}+)*+)"
         r"|(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[a-z0-9+/_=-]*+[A-Z])"
         r"(?=[A-Z0-9+/_=-]*+[a-z])[A-Za-z0-9+/_=-]{24,}+(?![A-Za-z0-9+/_=-])")
#: A text without these has no match of the kind; most texts stop here.
HINTS = (r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""", "AKIA", HEX, r"[A-Za-z0-9+/_=-]{18}|eyJ|PRIVATE KEY")
SPAN = "array<struct<start:int,end:int,kind:int,value:string>>"


def _spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Spans of the leftmost non-overlapping matches whose value has ``least`` characters (code points).

    The pieces between the matches and the matches themselves are measured in
    order, so that no position function is needed.
    """
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def step(acc, x):
        start = acc["pos"] + F.char_length(x["gap"])
        end = start + F.coalesce(F.char_length(x["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
        return F.struct(end.alias("pos"), F.when(F.char_length(x["value"]) >= least, F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    seed = F.struct(F.lit(0).alias("pos"), F.array().cast(SPAN).alias("out"))
    found = F.aggregate(zipped, seed, step, lambda acc: acc["out"])
    return F.when(text.rlike(HINTS[kind]), found).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, repo: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id, th (text hash), repo, owner and the spans found: ``base`` and ``other`` (outside base spans; a key block stays whole)."""
    text = F.col("text")
    rows = docs.select("doc_id", F.col(repo).cast("string").alias("repo"), F.col(owner).cast("string").alias("owner"),
                       text_of().alias("text"))
    found = rows.select("doc_id", "repo", "owner", F.xxhash64("text").alias("th"),
                        F.concat(_spans(text, 0, ASSIGN, 2, 8), _spans(text, 1, ACCESS, 0, 16), _spans(text, 2, HEX, 0, 32)).alias("base"),
                        _spans(text, 3, OTHER, 0, 16).alias("other"))
    apart = F.filter("other", lambda o: o["value"].startswith("-----BEGIN") | ~F.exists(
        "base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"])))
    return found.select("doc_id", "th", "repo", "owner", F.array_sort("base").alias("base"), apart.alias("other"))


def ownership(found: DataFrame) -> DataFrame:
    """h (value hash), owners, repos: in how many distinct owners and repositories each value occurs."""
    values = found.select("repo", "owner", F.explode(F.concat("base", "other")).alias("s"))
    held = values.select(F.sha2("s.value", 256).alias("h"), "owner", "repo").distinct()
    per_owner = held.groupBy("h", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return per_owner.groupBy("h").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"))


def judged(found: DataFrame, max_owners: int = 2) -> DataFrame:
    """doc_id, th, ``marks``: every span of a row with ``live`` (its value has at most ``max_owners`` owners)."""
    spans = found.select("doc_id", "th", F.explode(F.concat("base", "other")).alias("s"))
    spans = spans.select("doc_id", "th", "s", F.sha2("s.value", 256).alias("h"))
    known = ownership(found).select("h", (F.col("owners") <= max_owners).alias("live"))
    return spans.join(known, "h").groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct(
        F.col("s.start").alias("start"), F.col("s.kind").alias("kind"), F.col("s.end").alias("end"),
        (F.col("s.end") - F.char_length("s.value")).alias("from"), "live"))).alias("marks"))


def _said(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, repo: str = "doc_id", owner: str = "source", max_owners: int = 2) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example.

    Null and empty texts have no spans; a null owner or repository counts as
    one of its own; repeated rows each give a row; equal starts go by kind; an
    empty table gives an empty table.
    """
    found = materialise(scan(docs, repo, owner), "spans")
    marks = judged(found, max_owners).withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    out = found.join(marks, found["doc_id"].eqNullSafe(F.col("_id")) & (found["th"] == F.col("_th")), "left")
    ordered = F.array_sort(F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    out = out.withColumn("base", ordered).withColumn("marks", F.coalesce("marks", F.array().cast(
        "array<struct<start:int,kind:int,end:int,from:int,live:boolean>>")))
    shown = F.filter("marks", lambda m: (m["kind"] < 3) | m["live"])

    def count(spans, cond):
        return F.size(F.filter(spans, cond)).cast("long")

    def of(kind):
        return count("base", lambda s: s["kind"] == kind).alias(f"n_{KINDS[kind]}")

    return out.select(
        "doc_id", of(0), of(1), of(2),
        F.sha2(_said(F.col("base")), 256).alias("base_sha256"), _said(shown).alias("spans"),
        count("marks", lambda m: m["live"]).alias("n_live"), count("marks", lambda m: ~m["live"]).alias("n_example"))


def redact(docs: DataFrame, repo: str = "doc_id", owner: str = "source", max_owners: int = 2,
           stand_in: str = "[SECRET]") -> DataFrame:
    """``docs`` with the values that look live replaced by ``stand_in`` (n_chars follows); all rows and columns stay."""
    found = materialise(scan(docs, repo, owner), "spans")
    own, th, cut = (free_name(docs, c) for c in ("_id", "_th", "_cut"))
    live = judged(found, max_owners).select(F.col("doc_id").alias(own), F.col("th").alias(th), F.array_sort(F.transform(
        F.filter("marks", lambda m: m["live"]), lambda m: F.struct(m["from"].alias("from"), m["end"].alias("end")))).alias(cut))
    live = live.where(F.size(cut) > 0)
    text = text_of()
    rows = docs.join(live, docs["doc_id"].eqNullSafe(F.col(own)) & (F.xxhash64(text) == F.col(th)), "left")

    def step(acc, m):
        piece = F.when(m["from"] >= acc["pos"], F.concat(
            acc["out"], F.substring(F.col("text"), acc["pos"] + 1, m["from"] - acc["pos"]), F.lit(stand_in))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["pos"], m["end"]).alias("pos"), piece.alias("out"))

    clean = F.aggregate(cut, F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step,
                        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["pos"] + 1, F.char_length("text"))))
    rows = rows.withColumn("text", F.when(F.col(cut).isNotNull(), clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col(cut).isNotNull(), F.char_length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
