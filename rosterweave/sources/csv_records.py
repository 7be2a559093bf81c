"""CSV records without loss: a damaged record is an error with its text, the ones behind it are kept.

Files are read by line and split between tasks. Whether a line begins a record depends on the
quotes before it, and with a quote that never closes no count of them helps. So each line is judged
twice, as if it began outside and as if it began inside a quoted cell, and a record may go on over
several lines only where all of this holds:

* its first line opens a cell and does not close it;
* it ends at the next line that, begun inside a cell, is not wholly inside again, and that line is
  well-formed;
* its cells are as many as those of the header.

A first line for which it does not hold is damaged, and reading goes on with the line behind it.
Where two such records would overlap, the earlier one counts. What depends on earlier lines is
summed per block of lines first and then within blocks, so no file has to fit one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterweave.config import MISSING_CELLS
from rosterweave.functions.text import missing_as_null
from rosterweave.plans.staging import Stage
from rosterweave.sources.common import (
    ERROR,
    FILE,
    LINES,
    ORDINAL,
    RAW_RECORD,
    absent,
    file_of_scan,
    read_or_empty,
    string_columns,
)

OPEN = "Quote is never closed"
JUNK = "Text behind a closing quote"
_BLOCK = 13  # lines of a block, as a power of two
_SMALL_FILES = 10_000  # files whose headers are broadcast at most

# What a quoted cell holds; all quantifiers are possessive, so no text is tried twice.
_HELD = r'[^"]*+(?:""[^"]*+)*+'
_CELL = rf'(?:"{_HELD}"(?=,|\z)|[^",][^,]*+|(?=,|\z))'
_COMPLETE = rf"\A{_CELL}(?:,{_CELL})*+\z"
_OPENS = rf'\A(?:{_CELL},)*+"{_HELD}\z'
_CLOSES = rf'\A{_HELD}"(?:,{_CELL})*+\z'
_STAYS = rf'\A{_HELD}(?:"(?:,{_CELL})*?,"{_HELD})?\z'
_NEXT_CELL = rf',("{_HELD}"|[^",][^,]*+|)'


def _commas(text: Column) -> Column:
    """Commas between cells of a line that begins outside a cell."""
    bare = F.regexp_replace(text, rf'(\A|,)"{_HELD}("|\z)', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))


def _judged(lines: DataFrame) -> DataFrame:
    """``outside``: closed, open or bad; ``inside``: inside, closed or bad; and the commas of each."""
    bare = _bare(F.col("value"))
    plain = ~F.contains("value", F.lit('"'))
    outside = (
        F.when(plain | bare.rlike(_COMPLETE), "closed").when(bare.rlike(_OPENS), "open").otherwise("bad")
    )
    inside = (
        F.when(plain | bare.rlike(_STAYS), "inside").when(bare.rlike(_CLOSES), "closed").otherwise("bad")
    )
    rest = F.regexp_replace(bare, rf'\A{_HELD}("|\z)', "")
    return lines.select(
        "*",
        outside.alias("outside"),
        inside.alias("inside"),
        F.when(plain, 0).otherwise(_commas(bare)).alias("commas_outside"),
        F.when(plain, 0).otherwise(_commas(rest)).alias("commas_inside"),
    )


def _running(
    rows: DataFrame, place: str, sums: dict[str, Column], latest: dict[str, Column], before: bool = False
) -> DataFrame:
    """``rows`` with sums and greatest values over the rows of their file up to and with their own.

    With ``before``, without their own. Blocks are totalled first; a file is one row per block there.
    """
    rows = rows.withColumn("_block", F.shiftright(place, _BLOCK))
    made = {**{n: F.sum(c) for n, c in sums.items()}, **{n: F.max(c) for n, c in latest.items()}}
    totals = rows.groupBy("file", "_block").agg(*[c.alias(f"_{n}") for n, c in made.items()])
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "file", "_block",
        *[F.sum(f"_{n}").over(earlier).alias(f"_{n}") for n in sums],
        *[F.max(f"_{n}").over(earlier).alias(f"_{n}") for n in latest],
    )
    own = Window.partitionBy("file", "_block").orderBy(place)
    own = own.rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    zero = F.lit(0)
    new = {n: F.coalesce(f"_{n}", zero) + F.coalesce(F.sum(c).over(own), zero) for n, c in sums.items()}
    new |= {n: F.greatest(f"_{n}", F.max(c).over(own)) for n, c in latest.items()}
    joined = rows.join(carried, ["file", "_block"])
    return joined.withColumns(new).drop("_block", *[f"_{n}" for n in made])


def _spans(lines: DataFrame, stage: Stage) -> DataFrame:
    """``file, start, end``: first and last line of every record of several lines."""
    stops = F.col("inside") != "inside"
    marks = lines.where(stops | (F.col("outside") != "closed") | (F.col("commas_inside") > 0)).select(
        "file", "at", "n_cells", "outside", "inside", "commas_outside", "commas_inside"
    )
    marks = _running(
        marks, "at", {"stop": stops.cast("long"), "commas": F.col("commas_inside").cast("long")}, {}
    )
    marks = stage(marks.withColumn("stops", stops), "csv_marks")
    ends = marks.where("stops").select(
        "file", "stop", F.col("at").alias("end"), (F.col("inside") == "closed").alias("ends"),
        F.col("commas").alias("end_commas"),
    )
    first = marks.where("outside = 'open'").withColumn("stop", F.col("stop") + 1)
    fits = F.col("ends") & (
        F.col("commas_outside") + F.col("end_commas") - F.col("commas") + 1 == F.col("n_cells")
    )
    # A first line that is itself the end of a possible record competes with it; others do not.
    found = first.join(ends, ["file", "stop"]).where(fits).groupBy("file", "stop").agg(
        F.max(F.when(F.col("stops"), F.col("at"))).alias("rival"),
        F.min(F.when(~F.col("stops"), F.col("at"))).alias("free"),
    )
    chain = ends.select("file", "stop", "end").join(found, ["file", "stop"], "left")
    taken = F.col("free").isNotNull()
    # Behind a line that is decided by itself, rivals win and lose in turn.
    decided = F.when(taken | F.col("rival").isNull(), F.struct("stop", taken.alias("taken")))
    chain = _running(chain, "stop", {}, {"last": decided}, before=True)
    odd = (F.col("stop") - 1 - F.coalesce("last.stop", F.lit(0))) % 2 == 1
    lost = F.coalesce("last.taken", F.lit(False)) != odd
    start = F.coalesce(F.when(~lost, F.col("rival")), "free")
    return chain.select("file", start.alias("start"), "end").where("start is not null")


def _covered(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """``file, at, record``: places in records of several lines, and where the record of each starts.

    Places count on from line to line within a task of the scan, whose number is their upper part. A
    record that one task did not read whole is laid out over what each of them read of its file.
    """
    task = lambda c: F.shiftright(c, 33)
    whole = task("start") == task("end")
    laid = lambda first, last: F.explode(F.sequence(first, last)).alias("at")
    within = spans.where(whole).select("file", laid("start", "end"), F.col("start").alias("record"))
    read = lines.groupBy("file", task("at").alias("_task")).agg(
        F.min("at").alias("_first"), F.max("at").alias("_last")
    )
    split = spans.where(~whole).select("*", F.explode(F.sequence(task("start"), task("end"))).alias("_task"))
    across = split.join(read, ["file", "_task"]).select(
        "file", laid(F.greatest("start", "_first"), F.least("end", "_last")), F.col("start").alias("record")
    )
    return within.unionByName(across)


def _joined(lines: DataFrame, stage: Stage) -> DataFrame:
    """``file, at, text, outside`` of the records in files with cells that stay open."""
    spans = stage(_spans(lines, stage), "csv_spans")
    covered = stage(_covered(lines, spans), "csv_covered")
    # The one shuffle of whole lines. Places are far larger in memory than stored, so no broadcast.
    placed = lines.select("file", "at", "value", "outside").join(
        covered.hint("shuffle_hash"), ["file", "at"], "left"
    )
    placed = stage(placed, "csv_placed")
    several = placed.where("record is not null").groupBy("file", F.col("record").alias("at")).agg(
        F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts")
    )
    filled = F.filter("parts", lambda x: _filled(x["value"]))
    several = several.select(
        "file", "at", F.array_join("parts.value", "\n").alias("text"), F.lit("closed").alias("outside"),
        F.size(filled).cast("long").alias(LINES),
    )
    return several.unionByName(_single(placed.where("record is null")))


def _single(lines: DataFrame) -> DataFrame:
    return lines.where(_filled(F.col("value"))).select(
        "file", "at", F.col("value").alias("text"), "outside", F.lit(1).cast("long").alias(LINES)
    )


def _filled(line: Column) -> Column:
    return F.trim(_bare(line)) != ""


def _bare(line: Column) -> Column:
    """Without a carriage return at the end."""
    return F.when(F.endswith(line, F.lit("\r")), F.substr(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def _cells(text: Column) -> Column:
    """Cells of a well-formed record, without quotes around them."""
    plain = ~F.contains(text, F.lit('"'))
    given = F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(_NEXT_CELL), F.lit(1))
    quoted = lambda c: F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    cells = F.transform(given, lambda c: F.when(c.startswith('"'), quoted(c)).otherwise(c))
    return F.when(plain, F.split(text, ",", -1)).otherwise(cells)


def _small(files: DataFrame) -> DataFrame:
    return F.broadcast(files) if files.count() <= _SMALL_FILES else files


def _files(lines: DataFrame, stage: Stage) -> DataFrame:
    """Per file the place of its header, the names in it, and how many lines leave a cell open.

    Places are summed up first: numbers alone need no sort of the lines.
    """
    per_file = lines.groupBy("file").agg(
        F.min(F.when(_filled(F.col("value")), F.col("at"))).alias("head"),
        F.count_if(F.col("outside") == "open").alias("opens"),
    ).where("head is not null")
    heads = _small(stage(per_file, "csv_heads")).withColumnRenamed("head", "at")
    header = F.regexp_replace("value", r"\A\x{FEFF}|\r\z", "")
    names = _cells(header)
    return lines.select("file", "at", "value").join(heads, ["file", "at"]).select(
        "file", F.col("at").alias("head"), names.alias("names"), F.size(names).alias("n_cells"), "opens"
    )


def parse_csv(
    spark: SparkSession,
    path: str,
    columns: list[str],
    stage: Stage,
    encoding: str = "UTF-8",
    multiline: bool = True,
) -> DataFrame:
    """``file, lines``, ``columns`` by header name as text, ``ingest_ordinal, error, raw_record``.

    Every line that is not blank is in a row, in an error, or in a header. A record is an error if a
    quote in it never closes, if text stands behind a closing quote, or if it has more or fewer cells
    than the header of its file; its raw record is the name of the file and the text. Lines end with
    a line feed, before which a carriage return is dropped at the end of a record. Without
    ``multiline`` every line is a record. Cells that mean "missing" are null. Files of a folder may
    have their columns in different orders; one that lacks a column is refused.
    """

    def scan() -> DataFrame:
        text = spark.read.option("encoding", encoding).option("lineSep", "\n").text(path)
        return text.select(file_of_scan(), F.monotonically_increasing_id().alias("at"), "value")

    try:
        lines = stage(_judged(scan()), "csv_lines")
    except AnalysisException as error:
        if not absent(error):
            raise
        kinds = f"{FILE} string, {LINES} long, {string_columns(columns)}, {ORDINAL} long"
        kinds += f", {string_columns([ERROR, RAW_RECORD])}"
        return spark.createDataFrame([], kinds)
    files = stage(_files(lines, stage), "csv_files")
    for row in files.select("names").distinct().toLocalIterator():
        lacking = [c for c in columns if c not in row.names]
        if lacking:
            raise ValueError(f"{path} has no column {', '.join(lacking)}")
    files = _small(files)
    lines = lines.join(files.drop("names"), "file").where("at > head").drop("head")
    records = _single(lines.where("opens = 0") if multiline else lines)
    if multiline and not files.where("opens > 0").isEmpty():
        records = records.unionByName(_joined(lines.where("opens > 0"), stage))
    records = records.join(files.select("file", "names"), "file")
    return _typed(records, columns, lambda c: missing_as_null(c, MISSING_CELLS))


def _typed(records: DataFrame, columns: list[str], cell: Callable[[Column], Column]) -> DataFrame:
    cells = records.select("*", _cells(_bare(F.col("text"))).alias("cells"))
    found, wanted = F.size("cells"), F.size("names")
    count = F.concat(F.lit("Expected "), wanted, F.lit(" cells, found "), found)
    error = (
        F.when(F.col("outside") == "open", OPEN)
        .when(F.col("outside") == "bad", JUNK)
        .when(found != wanted, count)
    )
    name, bare = F.element_at(F.split("file", "/"), -1), F.regexp_replace("text", r"\r\z", "")
    kept = cells.select("*", error.alias(ERROR))
    return kept.select(
        FILE,
        LINES,
        *[cell(F.try_element_at("cells", F.array_position("names", c).cast("int"))).alias(c) for c in columns],
        F.col("at").alias(ORDINAL),
        ERROR,
        F.when(F.col(ERROR).isNotNull(), F.concat(name, F.lit(": "), bare)).alias(RAW_RECORD),
    )


def expected_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """``file, expected``: lines that are not blank, without the header."""

    def scan() -> DataFrame:
        text = spark.read.option("encoding", encoding).option("lineSep", "\n").text(path)
        return text.select("value", file_of_scan())

    lines = read_or_empty(spark, scan, f"value string, {FILE} string")
    return lines.groupBy(FILE).agg(
        F.greatest(F.count_if(_filled(F.col("value"))) - 1, F.lit(0)).alias("expected")
    )
