"""Secrets in whole texts, and credentials whose parts stand near each other.

Three kinds are always reported: assignments, access identifiers and long hexadecimal runs. Matches are the pattern's
leftmost non-overlapping ones; those that are too short are dropped afterwards, so what they covered is not searched
again. Positions come from splitting a text by the pattern: the lengths of the parts and of the matches between them add
up to the offsets, all in code points.

Linking adds weaker parts, each only if the others are near: a mixed run of 24 to 64 letters, digits and signs
(``part``) if an access identifier stands in its scope, and a host or address (``endpoint``) if both an access
identifier and a part, an assignment or a hexadecimal run stand in its scope. A scope is ``scope`` code points to either
side. The interval joins are semi-joins on the document and on cells of that size; each needed part is put into the
cells that its scope touches, so no pair of parts is ever made.

Null texts are empty and have no spans. Equal rows share their spans; rows with a null ``doc_id`` are rows like any
other. Extra columns are left behind, but for ``redact``, which keeps those of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, saved

#: Patterns and least lengths of the kinds that are always reported.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_HEAD = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12

PART = r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]{0,63}[0-9])(?=[A-Za-z0-9+/]{0,63}[A-Z])(?=[A-Za-z0-9+/]{0,63}[a-z])[A-Za-z0-9+/]{24,64}(?![A-Za-z0-9+/])"
ENDPOINT = r"(?<![A-Za-z0-9])(?:https?://[A-Za-z0-9.-]+(?::[0-9]+)?|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?)"
KINDS = ("assign", "access", "hex", "part", "endpoint")
SCOPE = 200


def spans_of(text: Column, pattern: str, wanted=None) -> Column:
    """Array of (start, end) of the matches; ``wanted`` decides on the matched string."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    # at the n-th match: all parts up to it and all matches before it
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,hit:string>>").alias("out"))

    def add(acc, x):
        begin = acc["at"] + x["size"]
        stop = begin + F.length(x["hit"])
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(F.struct(begin.alias("start"), stop.alias("end"), x["hit"].alias("hit")))).alias("out"))

    both = F.zip_with(found, F.slice(sizes, F.lit(1), F.greatest(F.size(found), F.lit(0))), lambda h, s: F.struct(h.alias("hit"), s.alias("size")))
    spans = F.aggregate(both, start, add)["out"]
    if wanted is not None:
        spans = F.filter(spans, lambda s: wanted(s["hit"]))
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def _long_enough(hit: Column) -> Column:
    return F.length(F.regexp_replace(hit, ASSIGN_HEAD, "")) >= ASSIGN_LEAST


def _of_kind(kind: int, found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _count(kind: int) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")


def candidates(docs: DataFrame) -> DataFrame:
    """Rows (doc_key, text_key, kind, start, end): what the patterns find in each distinct row that has any of it."""
    rows = keyed(docs)
    text = F.col("text")
    kinds = [spans_of(text, ASSIGN, _long_enough), spans_of(text, ACCESS), spans_of(text, HEX)]
    # weaker parts count near an access identifier only, so other texts are not searched for them
    none = F.array().cast("array<struct<start:int,end:int>>")
    kinds += [F.when(text.contains("AKIA"), spans_of(text, p)).otherwise(none) for p in (PART, ENDPOINT)]
    every = F.concat(*[_of_kind(k, found) for k, found in enumerate(kinds)])
    return rows.select("doc_key", "text_key", F.inline(every)).select("doc_key", "text_key", "kind", F.col("start").cast("long"), F.col("end").cast("long"))


def near(rows: DataFrame, others: DataFrame, scope: int, cell: int = SCOPE, how: str = "left_semi") -> DataFrame:
    """The rows that have (``left_anti``: have not) one of ``others`` in their document within ``scope`` of them.

    A row is in the cell of its start, a longer one in all cells from its start to its end; each of ``others`` is in all
    cells from which its scope can be met.
    """
    key = ["doc_key", "text_key"]
    cells = others.select(*[F.col(c).alias(f"o_{c}") for c in (*key, "start", "end")])
    longest = 64 + 2 * cell  # of a match in one cell
    touched = F.sequence(F.floor((F.col("o_start") - scope - longest) / cell), F.floor((F.col("o_end") + scope) / cell))
    cells = cells.withColumn("o_cell", F.explode(touched))
    first, last = F.floor(F.col("start") / cell), F.floor(F.col("end") / cell)
    dealt = rows.withColumn("cell", F.explode(F.sequence(first, F.when(F.col("end") - F.col("start") > longest, last).otherwise(first))))
    on = [dealt[c] == cells[f"o_{c}"] for c in (*key, "cell")]
    within = (cells["o_start"] - scope < dealt["end"]) & (dealt["start"] < cells["o_end"] + scope)
    met = dealt.join(cells, [*on, within], "left_semi").drop("cell").distinct()
    return met if how == "left_semi" else rows.join(met, rows.columns, how)


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Keep the strong kinds, and the weak ones whose complement stands in their scope.

    A run that overlaps a strong span is part of that and no other secret.
    """
    strong, access = found.where("kind <= 2"), found.where("kind = 1")
    parts = near(near(found.where("kind = 3"), access, scope), strong, 0, how="left_anti")
    secrets = parts.unionByName(found.where("kind in (0, 2)"))
    ends = near(near(found.where("kind = 4"), access, scope), secrets, scope)
    return strong.unionByName(parts).unionByName(ends)


def spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Distinct rows (doc_key, text_key) with ``found``: their spans as (start, kind number, end) in that order."""
    found = saved(candidates(docs), "secrets").distinct()
    return link(found, scope).groupBy("doc_key", "text_key").agg(F.sort_array(F.collect_set(F.struct("start", "kind", "end"))).alias("found"))


def _text_of(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per document: number of spans of each strong kind, hash of those spans, and all spans."""
    base = keyed(docs).select("doc_id", "doc_key", "text_key")
    found = F.coalesce("found", F.array().cast("array<struct<start:long,kind:int,end:long>>"))
    out = base.join(spans(docs, scope), ["doc_key", "text_key"], "left").select("doc_id", found.alias("found"))
    count = [_count(k).alias(n) for k, n in enumerate(("n_assign", "n_access", "n_hex"))]
    strong = F.filter("found", lambda s: s["kind"] <= 2)
    linked = F.size(F.filter("found", lambda s: s["kind"] > 2)).cast("long")
    return out.select("doc_id", *count, F.sha2(_text_of(strong).cast("binary"), 256).alias("base_sha256"), _text_of(F.col("found")).alias("spans"), linked.alias("n_linked"))


def redact(docs: DataFrame, scope: int = SCOPE, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``mask``; overlapping spans are one. ``n_chars`` follows the text."""
    names = docs.columns
    rows = docs.withColumns({"__doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)), "__text": F.xxhash64(F.coalesce("text", F.lit("")))})
    found = spans(docs, scope).select(F.col("doc_key").alias("__doc"), F.col("text_key").alias("__text"), F.col("found").alias("__found"))
    rows = rows.join(found, ["__doc", "__text"], "left")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(acc, s):
        before = F.substring(rows["text"], (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], before, F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    clean = F.aggregate("__found", start, add, lambda acc: F.concat(acc["out"], F.substring(rows["text"], (acc["at"] + 1).cast("int"), F.length(rows["text"]))))
    rows = rows.withColumn("text", F.when(F.col("__found").isNull(), F.col("text")).otherwise(clean))
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.when(F.col("__found").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*names)
