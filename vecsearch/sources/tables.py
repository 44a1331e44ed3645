"""Readers and writers: sequences, hits, annotations, families, vectors, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.common import settle, stored

# The columns of a tabular aligner result, in file order.
HIT_SCHEMA = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("pident", T.DoubleType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("mismatch", T.IntegerType()),
    T.StructField("gapopen", T.IntegerType()),
    T.StructField("qstart", T.IntegerType()),
    T.StructField("qend", T.IntegerType()),
    T.StructField("sstart", T.IntegerType()),
    T.StructField("send", T.IntegerType()),
    T.StructField("evalue", T.DoubleType()),
    T.StructField("bitscore", T.DoubleType()),
])
FAMILY_SCHEMA = "accession string, pfam string, length int"
ANNOTATION_TYPE = "map<string, struct<domains: array<string>, ec_numbers: array<string>>>"
ANNOTATION_ROW = "id string, domains array<string>, ec_numbers array<string>"

# Tolerances of the reload check.
RTOL, ATOL = 1e-5, 1e-8

ROW_BITS = (1 << 33) - 1


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Sequence records: id (first header word), seq (lines joined, whitespace removed).

    Records are split at ``\\n>``, so a ``>`` inside a header is harmless and large files still
    split over tasks.
    """
    record = F.regexp_replace("value", "^>", "")
    header, body = F.substring_index(record, "\n", 1), F.regexp_extract(record, r"(?s)^[^\n]*\n(.*)$", 1)
    rows = spark.read.option("lineSep", "\n>").text(path)
    return rows.select(F.regexp_extract(header, r"^\s*(\S*)", 1).alias("id"),
                       F.regexp_replace(body, r"\s+", "").alias("seq")).where("id <> '' or seq <> ''")


def write_fasta(df: DataFrame, path: str, width: int = 60) -> None:
    """Write id, seq as sequence records with lines of ``width`` letters."""
    body = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    df.select(F.concat(F.lit(">"), F.col("id").cast("string"), F.lit("\n"), body)).write.text(path)


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated hits without header plus ``hit_seq``, the file order; empty if unreadable.

    ``hit_seq`` is (file path, block start + row number inside the block); a block has fewer rows than
    bytes. It only serves to order rows, whatever the number of files.
    """
    try:
        raw = spark.read.csv(path, sep="\t", schema=HIT_SCHEMA)
    except AnalysisException:
        place = T.StructType([T.StructField("file", T.StringType()), T.StructField("place", T.LongType())])
        return spark.createDataFrame([], T.StructType([*HIT_SCHEMA.fields, T.StructField("hit_seq", place)]))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))
    place = (F.col("_metadata.file_block_start") + row).alias("place")
    return raw.select("*", F.struct(F.col("_metadata.file_path").alias("file"), place).alias("hit_seq"))


def write_hits(hits: DataFrame, path: str) -> None:
    """Write hits as tab-separated text in ``hit_seq`` order."""
    hits.orderBy("hit_seq").select(*HIT_SCHEMA.names).write.csv(
        path, sep="\t")


def read_annotations(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Annotations from JSON objects keyed by id: id, domains, ec_numbers; empty without a file.

    A file may hold one object of any size or one after the other; a folder any number of files. Large files are read in blocks by
    several tasks. Of repeated ids the last one counts. Text that is no such object gives no row.
    """
    if not path:
        return spark.createDataFrame([], ANNOTATION_ROW)
    try:
        entries = json_entries(spark, path)
    except AnalysisException:
        return spark.createDataFrame([], ANNOTATION_ROW)
    none = F.array().cast("array<string>")
    found = entries.select("place", F.explode(F.from_json("value", ANNOTATION_TYPE)).alias("id", "a")).select(
        "id", F.struct("place", F.coalesce("a.domains", none).alias("domains"), F.coalesce("a.ec_numbers", none).alias("ec_numbers")).alias("a"))
    last = found.groupBy("id").agg(F.max_by("a", "a.place").alias("a"))
    return last.select("id", "a.domains", "a.ec_numbers")


def json_entries(spark: SparkSession, path: str) -> DataFrame:
    """The entries of JSON objects keyed by name, each as an object of its own: value, place (file and position, for their order).

    The text is split at closing braces, so that Spark reads a large file in blocks. Whether a brace is part of a string, and how
    deep it lies, follows from all before it: a first pass notes for every block how many quotes it has and how many levels it
    climbs if it starts outside or inside a string; running sums over the blocks give the state at each start, and a second pass
    cuts the entries. Only what crosses the border of blocks is put together by a shuffle.
    """
    piece = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))
    bare = F.regexp_replace(F.regexp_replace("value", r"(?s)\\.", ""), r'[^"{]+', "")
    lines = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), piece.alias("at"), "value", bare.alias("marks"))
    summed = lines.select("file", "block", "marks").mapInArrow(
        _block_climbs, "file string, block long, quotes long, outside long, inside long")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    climb = F.when(F.col("quoted") == 1, F.col("inside")).otherwise(F.col("outside"))
    # One row per block.
    starts = summed.withColumn("quoted", quotes).select(
        "file", "block", "quoted", F.coalesce(F.sum(climb).over(before), F.lit(0)).alias("depth"))
    cut = lines.join(starts, ["file", "block"]).sortWithinPartitions("file", "block", "at").select(
        "file", "block", "at", "value", "marks", "quoted", "depth").mapInArrow(
        _cut_entries, "file string, block long, no long, value string, opens boolean, closes boolean")
    cut = stored(cut, "entries")
    whole = F.col("opens") & F.col("closes")
    # At most two rows per block.
    upto = Window.partitionBy("file").orderBy("block", "no")
    torn = cut.where(~whole).withColumn("entry", F.sum(F.col("opens").cast("int")).over(upto))
    parts = F.sort_array(F.collect_list(F.struct("block", "no", "value")))
    joined = torn.groupBy("file", "entry").agg(parts.alias("parts")).select(
        "file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["no"].alias("no"),
        F.concat_ws("", F.col("parts")["value"]).alias("value"))
    every = cut.where(whole).select("file", "block", "no", "value").unionByName(joined)
    # What stands before an entry is an opening brace or a comma, its own braces are whole.
    inner = F.regexp_replace(F.regexp_replace("value", r"^[\s{,}]+", ""), r"\s+$", "")
    return every.where(inner != "").select(F.concat(F.lit("{"), inner, F.lit("}")).alias("value"), F.struct("file", "block", "no").alias("place"))


def _block_climbs(batches):
    """One row per block of rows (file, block, marks): its quotes, and how many levels it climbs if it starts outside or inside a string."""
    import pyarrow as pa
    now, found = None, []

    def rows():
        columns = zip(*found, strict=True) if found else [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["file", "block", "quotes", "outside", "inside"])

    for batch in batches:
        for file, block, marks in zip(batch["file"].to_pylist(), batch["block"].to_pylist(), batch["marks"].to_pylist(), strict=True):
            if (file, block) != now:
                now = file, block
                found.append([file, block, 0, 0, 0])
            state = found[-1]
            opened = [part.count("{") for part in marks.split('"')]
            for start in (0, 1):
                quoted = (state[2] + start) % 2
                state[3 + start] += sum(opened[quoted::2]) - (1 - (quoted + len(opened) - 1) % 2)
            state[2] += len(opened) - 1
    yield rows()


def _cut_entries(batches):
    """The entries of each block of rows (file, block, at, value, marks, quoted, depth): whole ones, and what lies before and after them.

    ``opens`` says that the text starts at the border of entries, ``closes`` that it ends there.
    """
    import pyarrow as pa
    now, quoted, depth, no, held, opens = None, 0, 0, 0, [], True
    names = ["file", "block", "no", "value", "opens", "closes"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    for batch in batches:
        out = []
        for file, block, value, marks, first_quoted, first_depth in zip(
                *(batch[name].to_pylist() for name in ("file", "block", "value", "marks", "quoted", "depth")), strict=True):
            if (file, block) != now:
                if held:
                    out.append((*now, no, "".join(held), opens, False))
                now, quoted, depth, no, held = (file, block), first_quoted, first_depth, 0, []
                opens = not quoted and depth <= 1
            parts = marks.split('"')
            depth += sum(part.count("{") for part in parts[quoted::2])
            quoted = (quoted + len(parts) - 1) % 2
            depth -= 1 - quoted
            held.append(value)
            if quoted or depth > 0:
                held.append("}")
            if not quoted and depth <= 1:
                out.append((file, block, no, "".join(held), opens, True))
                no, held, opens = no + 1, [], True
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 6, kinds, strict=True)], names)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*now, no, "".join(held), opens, False), kinds, strict=True)], names)


def write_annotations(annot: DataFrame, path: str) -> None:
    """Write annotations as JSON objects keyed by id, one object per file part."""
    entry = F.concat(F.to_json(F.struct("id")), F.lit(""))
    name = F.regexp_extract(entry, r'^\{"id":(.*)\}$', 1)
    line = F.concat(name, F.lit(":"), F.to_json(F.struct("domains", "ec_numbers")))

    def objects(batches):
        import pyarrow as pa
        first = True
        for batch in batches:
            lines = [(("{" if first and i == 0 else ",") + v)
                     for i, v in enumerate(batch.column(0).to_pylist())]
            first = first and not lines
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        if not first:
            yield pa.RecordBatch.from_arrays([pa.array(["}"], pa.string())], names=["value"])

    annot.select(line.alias("value")).mapInArrow(objects, "value string").write.text(path)


def read_families(spark: SparkSession, path: str) -> DataFrame:
    """Family map with header: accession, pfam, length."""
    return spark.read.csv(path, header=True, sep="\t", schema=FAMILY_SCHEMA)


def read_vectors(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """Vector table (id, embedding); refuses other files, ragged vectors and repeated ids."""
    df = spark.read.parquet(path)
    if not {"id", "embedding"} <= set(df.columns):
        raise ValueError(f"{path} is not a vector table: needs columns id, embedding")
    df = df.select("id", F.col("embedding").cast("array<float>").alias("embedding"))
    if check:
        check_vectors(df)
    return df


def check_vectors(df: DataFrame) -> None:
    """Raise if vectors differ in length or an id repeats."""
    sizes = df.agg(F.min(F.size("embedding")).alias("lo"), F.max(F.size("embedding")).alias("hi")).first()
    if sizes["lo"] != sizes["hi"]:
        raise ValueError(f"vectors differ in length: {sizes['lo']}..{sizes['hi']}")
    if not df.groupBy("id").count().where("count > 1").isEmpty():
        raise ValueError("vector ids are not unique")


def write_vectors(df: DataFrame, path: str, verify: bool = False) -> DataFrame:
    """Save as 4-byte floats; one row (rows, mismatches), the latter null unless verified."""
    df.select("id", F.col("embedding").cast("array<float>").alias("embedding")).write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    if not verify:
        return stored.agg(F.count("*").alias("rows"), F.lit(None).cast("bigint").alias("mismatches"))
    pair = F.arrays_zip(F.col("a").alias("a"), F.col("b").alias("b"))
    off = F.exists(pair, lambda p: F.coalesce(
        F.abs(p["a"] - p["b"]) > ATOL + RTOL * F.abs(p["b"]), F.lit(True)))
    both = df.select("id", F.col("embedding").cast("array<double>").alias("a")).join(
        stored.select("id", F.col("embedding").cast("array<double>").alias("b")), "id", "full")
    bad = F.col("a").isNull() | F.col("b").isNull() | off
    return both.agg(F.count("*").alias("rows"), F.coalesce(F.sum(bad.cast("bigint")), F.lit(0)).alias("mismatches"))


def load_or_compute(spark: SparkSession, path: str | None, compute: Callable[[], DataFrame]) -> DataFrame:
    """The table stored at ``path``; computed and stored there first if it does not exist."""
    if not path:
        return compute()
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        compute().write.parquet(path)
        return spark.read.parquet(path)


def with_fallback_ids(df: DataFrame, order_col: str, prefix: str = "prot_", range_rows: int = 1_000_000) -> DataFrame:
    """Name unnamed rows ``prefix`` + 0-based position by ``order_col``.

    Rows are put into value ranges of about ``range_rows``, so their number follows the table; a position is
    the place inside the range and the total of the ranges before it. No window holds the whole table.
    """
    ranges = max(1, -(-df.count() // range_rows))
    ordered = df.repartitionByRange(ranges, order_col).sortWithinPartitions(order_col)
    numbered = settle(ordered.withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit(ROW_BITS))
    # One row per range.
    totals = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    named = F.concat(F.lit(prefix), (F.col("_offset") + place).cast("string"))
    new_id = F.coalesce(F.col("id").cast("string"), named) if "id" in df.columns else named
    joined = numbered.withColumn("_part", part).join(offsets, "_part")
    return joined.withColumn("id", new_id).drop("_part", "_offset", "_at")


def resolve_queries(wanted: DataFrame, vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queries that have a vector: query_id, query_vec; ids that have none: query_id)."""
    known = vectors.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vec"))
    ids = wanted.select("query_id").distinct()
    return ids.join(known, "query_id"), ids.join(known, "query_id", "left_anti")


def write_report(lines: DataFrame, path: str, summary: DataFrame | None = None) -> None:
    """Write report lines as UTF-8 text in (query, section, line) order, then the closing ``summary`` lines."""
    if summary is not None:
        lines = lines.unionByName(summary, allowMissingColumns=True)
    lines.orderBy(F.asc_nulls_last("query_id"), "section", "line_no").select("line").write.text(path)
