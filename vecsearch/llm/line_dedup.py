"""Repeated passages of lines: overlapping windows of three lines, found and removed over all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

WINDOW = 3
# A line, or a part of it up to the end of a sentence, each with what divides it from the next: joined they give the text.
SENTENCE = r'[^\n]*?(?:[\p{L}\p{N}]{2}[.!?…][")\]]* +\n?|[。！？]|\n)|[^\n]+'


def _hash(*parts: Column) -> Column:
    """128-bit content hash as a pair of longs."""
    return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(97), *parts).alias("h2"))


def lines_of(text: Column, sentences: bool = False) -> Column:
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)) if sentences else F.split(text, "\n", -1)


def windows(keyed: DataFrame, size: int, sentences: bool = False) -> DataFrame:
    """(doc, th, pos, window): hash of every ``size`` consecutive lines that aren't all blank."""
    trim = (lambda x: F.trim(x, F.lit(" \n"))) if sentences else (lambda x: F.trim(x))
    trimmed = F.transform(lines_of(F.col("text"), sentences), trim)
    lines = keyed.select("doc", "th", trimmed.alias("lines")).where(F.size("lines") >= size)
    at = lambda i: _hash(*[F.col("lines")[i + k] for k in range(size)])
    blank = lambda i: F.concat(*[F.col("lines")[i + k] for k in range(size)]) == ""
    each = F.transform(F.sequence(F.lit(0), F.size("lines") - size),
                       lambda i: F.when(~blank(i), F.struct(i.alias("pos"), at(i).alias("window"))))
    return lines.select("doc", "th", F.explode(each).alias("w")).where("w is not null").select("doc", "th", "w.pos", "w.window")


def drop_repeated_lines(docs: DataFrame, size: int = WINDOW, sentences: bool = False) -> DataFrame:
    """All columns of ``docs``; ``text`` without later occurrences of any ``size`` consecutive lines, and ``lines_removed``.

    Lines are compared without spaces at their ends. Of all places where the same ``size`` lines follow one another, the first
    by (doc_id, text hash, position) stays, together with places that overlap it in its own document; the lines covered by any
    other are removed. Texts with fewer lines and windows of blank lines alone take no part. Null text stays null and
    empty text empty (0 removed). A null doc_id comes before all others. Rows equal in doc_id and text are one document and fare
    alike. An empty table gives no row.

    With ``sentences`` a line also ends after a sentence (two letters or digits, a full stop or the like, a space), so that a
    passage on one long line, or one that begins and ends inside a line, is found as well; ``lines_removed`` counts these
    shorter units. A passage of fewer than ``size`` whole units stays either way.
    """
    doc, th, pos = (fresh(docs, c) for c in ("dedup_doc", "dedup_hash", "dedup_starts"))
    keyed = docs.withColumns({doc: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), th: F.xxhash64("text")})
    plain = keyed.where(F.col("text").isNotNull()).select(
        F.struct(F.col("doc_id").cast("long").alias("id")).alias("doc"), F.col(th).alias("th"), F.col("text").cast("string").alias("text"))
    w = windows(plain, size, sentences)
    place = F.struct("doc", "th", "pos")
    first = (w.groupBy("window").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where("first <> last"))
    far = ((F.col("doc") != F.col("first.doc")) | (F.col("th") != F.col("first.th"))
           | (F.col("pos") >= F.col("first.pos") + size))
    later = w.join(first.select("window", "first"), "window").where(far)
    starts = (later.groupBy("doc", "th").agg(F.collect_set("pos").alias(pos))
              .select(F.coalesce(F.col("doc.id").cast("string"), F.lit("")).alias(doc), F.col("th").alias(th), pos))
    joined = keyed.join(starts, [doc, th], "left")
    lines = lines_of(F.col("text"), sentences)
    covered = F.flatten(F.transform(pos, lambda p: F.array(*[p + k for k in range(size)])))

    def rest(lines: Column) -> Column:
        keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
        lean = F.array_join(F.transform(keep, lambda i: lines[i]), "" if sentences else "\n")
        return F.struct(lean.alias("lean"), (F.size(lines) - F.size(keep)).cast("long").alias("gone"))

    # The pattern is costly and would run again for each kept line: as an element of an array it runs once.
    left = F.transform(F.array(lines), rest)[0] if sentences else rest(lines)
    removed = F.when(F.col(pos).isNull(), 0).otherwise(left["gone"]).cast("long")
    lean = left["lean"]
    out = joined.withColumns({"lines_removed": removed, "text": F.when(F.col(pos).isNull(), F.col("text")).otherwise(lean)})
    return out.select(*docs.columns, "lines_removed")
