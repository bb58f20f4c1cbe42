"""Reading folders of application CSV files."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import rules
from ..operators.joins import lookup_join
from ..session import scratch_path, settled

#: Order of rows in the input, for frames scanned with ``positions=True``.
POSITION = ("source_file", "_block", "_row")


class MissingColumns(ValueError):
    """A batch file lacks a required column."""


def _listing(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # Only path and length are selected: the content is never read.
    return reader.load(paths).select("path", "length")


def discover_batches(
    spark: SparkSession, folder: str, glob: str = rules.BATCH_GLOB, finished: DataFrame | None = None
) -> list[str]:
    """Batch files directly in ``folder``, by name. No files is a normal answer.

    Files whose ``path`` is in ``finished`` are left out by a join, so only the list
    of waiting files comes to the driver. Raises ``NotADirectoryError`` when the
    folder does not exist.
    """
    try:
        listing = _listing(spark, folder, glob).select("path")
        if finished is not None:
            listing = listing.join(finished.select("path").distinct(), "path", "left_anti")
        found = [r["path"] for r in listing.collect()]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise NotADirectoryError(f"no such input folder: {folder}") from error
        raise
    plain = folder.rstrip("/")
    if any(p.split(":", 1)[-1].rstrip("/") == plain.split(":", 1)[-1] for p in found):
        raise NotADirectoryError(f"not a folder: {folder}")
    return sorted(found, key=lambda p: (p.rsplit("/", 1)[-1], p))


def _csv(spark: SparkSession, multi_line: bool):
    return (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line)
    )


#: Encoded URI of the file a row was read from, and where its split starts in it.
_FILE, _BLOCK = "_metadata.file_path", "_metadata.file_block_start"


def _lines(spark: SparkSession, files: Sequence[str], **columns: Column) -> DataFrame:
    """Lines of the files in parallel splits: (file, block, id, line) and ``columns``.

    ``block`` is where a split starts in its file. Inside a task rows come in reading order, so
    ``id`` orders the lines of a block. A carriage return at the end stays on the line.
    """
    raw = spark.read.option("lineSep", "\n").text(list(files))
    return raw.select(F.col(_FILE).alias("file"), F.col(_BLOCK).alias("block"), F.monotonically_increasing_id().alias("id"),
                      F.col("value").alias("line"), *[c.alias(n) for n, c in columns.items()])


def _without_return(line: Column) -> Column:
    return F.regexp_replace(line, "\\r$", "")


def _odd(line: Column) -> Column:
    """Does the line have an odd number of quotes? Then a quoted field opens or closes in it."""
    return (F.length(line) - F.length(F.translate(line, '"', ""))) % 2 == 1


def _layouts(spark: SparkSession, files: Sequence[str]) -> list[tuple[str, str | None, bool, bool]]:
    """(file, first line, whole_lines, returns) of every file, from one text scan of all of them.

    ``whole_lines`` tells that Spark's line-by-line CSV reading gives the records of the file. That
    holds when no record spans lines (then no line has an odd number of quotes), no line consists of
    blanks only (it is a row, which line-by-line reading would skip), and no carriage return stands
    inside a line (it belongs to a field). Only what a file holds decides, never its size.
    ``returns`` tells that the first line ends with a carriage return. One row per file is gathered.
    """
    line = _without_return(F.col("line"))
    awkward = _odd(line) | line.rlike("^[\\x00-\\x20]+$") | F.contains(line, F.lit("\r"))
    # The least id marks the first line of a file.
    first = F.min(F.when((F.col("block") == 0) & (line != ""), F.struct("id", line.alias("line"), F.endswith("line", F.lit("\r")).alias("returns"))))
    scanned = _lines(spark, files).groupBy("file").agg(first.alias("first"), F.bool_or(awkward).alias("awkward"))
    # The metadata column is an encoded URI; ``path`` can be read again as it is.
    listed = spark.read.format("binaryFile").load(list(files)).select("path", F.col(_FILE).alias("file"))
    found = listed.join(scanned, "file", "left").select(
        "path", F.col("first.line").alias("line"), (~F.coalesce("awkward", F.lit(False))).alias("whole"),
        F.coalesce("first.returns", F.lit(False)).alias("returns"),
    )
    return sorted(((r["path"], r["line"], r["whole"], r["returns"]) for r in found.collect()), key=lambda f: f[0])


def _quote_states(lines: DataFrame) -> DataFrame:
    """(file, block, open, owner, owner_toggles) for each block of each file.

    Quoted fields open and close at the lines with an odd number of quotes. A running sum of their
    number over the blocks in front tells whether a field is ``open`` where the block starts; then the
    record belongs to the last block in front that has such a line, and begins at its last one.
    """
    blocks = lines.groupBy("file", "block").agg(F.count_if(_odd(F.col("line"))).alias("toggles"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("toggles") > 0, F.struct("block", "toggles")), ignorenulls=True).over(before)
    return blocks.select(
        "file", "block", (F.coalesce(F.sum("toggles").over(before), F.lit(0)) % 2 == 1).alias("open"),
        owner["block"].alias("owner"), owner["toggles"].alias("owner_toggles"),
    )


def _records(spark: SparkSession, files: Sequence[str], returns: bool) -> DataFrame:
    """(file, source_file, _block, _row, record) of files in which a record need not be a line.

    The files are read as lines in parallel. The quotes of all blocks in front of a block tell whether
    it starts inside a quoted field, those in front of a line inside its block tell the same
    of the line. A line outside that leaves no field open is a record. Other lines carry the block and the
    number of the line that opened their field, and are joined by these; so a record may cross any number of blocks.
    With ``returns`` the files end their lines with carriage returns, which then aren't part of
    quoted fields either. Empty lines outside fields are no records. The header is still among them.
    """
    lines = _lines(spark, files, source_file=F.col("_metadata.file_name"))
    state = lookup_join(lines, settled(_quote_states(lines)), ["file", "block"], "inner")
    inside = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    odd = _odd(F.col("line")).cast("int")
    counted = state.withColumns({"odd": odd, "toggles": F.sum(odd).over(inside)})
    after = (F.col("toggles") + F.col("open").cast("int")) % 2
    told = counted.withColumns({"after": after, "prior": (after + F.col("odd")) % 2})
    own = _without_return(F.col("line"))
    whole = told.where("prior = 0 and after = 0").where(own != "").select(
        "file", "source_file", F.col("block").alias("_block"), F.col("id").alias("_row"), own.alias("record"))

    opened = F.col("toggles") - F.when((F.col("odd") == 1) & (F.col("prior") == 1), 1).otherwise(0)
    begun_here = opened > 0
    pieces = told.where("prior = 1 or after = 1").groupBy(
        "file", "source_file", F.when(begun_here, F.col("block")).otherwise(F.col("owner")).alias("_begin"),
        F.when(begun_here, opened).otherwise(F.col("owner_toggles")).alias("_number"),
    ).agg(F.array_sort(F.collect_list(F.struct("block", "id", own.alias("line") if returns else "line"))).alias("pieces"))
    joined = pieces.withColumn("first", F.get("pieces", F.lit(0))).select(
        "file", "source_file", F.col("first.block").alias("_block"), F.col("first.id").alias("_row"),
        _without_return(F.array_join("pieces.line", "\n")).alias("record"),
    )
    path = scratch_path(spark, "records")
    whole.unionByName(joined).write.parquet(path)
    return spark.read.parquet(path)


def _plain_quotes() -> Column:
    """Does every quoted field of a record begin and end at the field's borders?

    Only then do the quotes alone tell where records end: a quote inside an unquoted field opens nothing.
    """
    rest = F.regexp_replace(F.replace("record", F.lit('""')), r'(\A|,)"[^"]*"(?=,|\z)', "$1")
    return ~F.contains(rest, F.lit('"'))


def _header(spark: SparkSession, file: str, first: str | None) -> tuple[str, ...]:
    """Column names of a file, empty and repeated ones made distinct by their place.

    A name with a line break needs a look at more than the first line.
    """
    if first is None:
        return ()
    if first.count('"') % 2:
        return tuple(_csv(spark, True).csv(file).columns)
    names = next(csv.reader([first]), [])
    seen = Counter(n.lower() for n in names)
    return tuple(n if n and seen[n.lower()] == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names))


def scan_batches(
    spark: SparkSession,
    files: Iterable[str],
    columns: Mapping[str, str] = rules.SOURCE_COLUMNS,
    positions: bool = False,
) -> DataFrame:
    """All rows of the files as text, columns by header name, with ``source_file``.

    Spark binds CSV columns by position, so files are grouped by header and each
    group is read with its own; column order may differ and extra columns are
    ignored. Files whose records are lines are read by Spark's CSV source; of the others the
    records are put together from lines first (``_records``) and kept in the scratch folder.
    Both are read in parallel splits. Only a file with a quote inside an unquoted field, or
    after the end of a quoted one, is read by one task. ``positions`` adds the columns of ``POSITION``.
    """
    files = list(files)
    if not files:
        raise ValueError("no batch files given")
    layouts: dict[tuple[tuple[str, ...], bool, bool], list[str]] = {}
    for file, first, whole, returns in _layouts(spark, files):
        header = _header(spark, file, first)
        missing = [c for c in columns if c not in header]
        if missing:
            raise MissingColumns(
                f"{file}: missing column(s) {', '.join(missing)}; found {', '.join(sorted(header)) or 'none'}"
            )
        layouts.setdefault((header, whole, returns and not whole), []).append(file)

    place = {"_block": F.col(_BLOCK), "_row": F.monotonically_increasing_id()}

    def picked(raw: DataFrame, header: tuple[str, ...], place: Mapping[str, Column], source_file: Column) -> DataFrame:
        named = [F.col(f"`{source}`").alias(target) for source, target in columns.items()]
        ordered = [c.alias(n) for n, c in place.items()] if positions else []
        return raw.select(*named, source_file.alias("source_file"), *ordered)

    def read(header: tuple[str, ...], multi_line: bool, group: list[str]) -> DataFrame:
        schema = StructType([StructField(c, StringType()) for c in header])
        raw = _csv(spark, multi_line).schema(schema).csv(group)
        if multi_line:
            # With mixed line ends the carriage return of some lines stays in the last field.
            end = F.regexp_replace(F.col(f"`{header[-1]}`"), "\\r$", "")
            raw = raw.withColumn(header[-1], F.nullif(end, F.lit("")))
        return picked(raw, header, place, F.col("_metadata.file_name"))

    def joined(header: tuple[str, ...], returns: bool, group: list[str]) -> list[DataFrame]:
        found = _records(spark, group, returns)
        head = F.min(F.struct("_block", "_row")).alias("head")
        told = settled(found.groupBy("file").agg(head, F.bool_and(_plain_quotes()).alias("plain")))
        odd = {r["file"] for r in told.where("not plain").select("file").collect()}
        rows = lookup_join(found, told.where("plain").select("file", "head"), ["file"], "inner").where(
            F.struct("_block", "_row") != F.col("head"))
        fields = ", ".join(f"c{i} string" for i in range(len(header)))
        cells = rows.withColumn("cells", F.from_csv("record", fields, {"quote": '"', "escape": '"'}))
        raw = cells.select("source_file", "_block", "_row", *[F.col(f"cells.c{i}").alias(c) for i, c in enumerate(header)])
        frames = [picked(raw, header, {c: F.col(c) for c in place}, F.col("source_file"))] if len(odd) < len(group) else []
        if odd:
            listed = spark.read.format("binaryFile").load(group).select("path", F.col(_FILE).alias("file")).collect()
            frames.append(read(header, True, [r["path"] for r in listed if r["file"] in odd]))
        return frames

    frames: list[DataFrame] = []
    for (header, whole, returns), group in layouts.items():
        frames += [read(header, False, group)] if whole else joined(header, returns, group)
    return union_batches(frames)


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, duplicates kept."""
    if not frames:
        raise ValueError("no frames given")
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out
