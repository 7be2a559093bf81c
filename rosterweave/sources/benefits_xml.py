"""Benefits enrolments: XML elements ``<enrollment>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.functions.text import strip
from rosterweave.sources.common import (
    ERROR,
    FILE,
    RAW_RECORD,
    file_of_scan,
    read_or_empty,
    string_columns,
    with_ordinal,
)

TEXTS = ["employee_id", "plan_type", "coverage_level", "enrollment_date"]
PREMIUMS = ["premium_employee", "premium_employer"]
COLUMNS = TEXTS + PREMIUMS
UNREADABLE = "unreadable"
BAD_ELEMENT = "Element is not well-formed"
_END = "</enrollment>"
_START = r"<enrollment(?=[\s>])"

# Fixed value: number texts beyond plain decimals (any case, single underscores in digits).
SPECIAL_NUMBER = (
    r"(?i)^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?|inf|infinity|nan)$"
)
# An element of the columns in their order, as plain texts: no attributes, references, comments or line
# ends that an XML reader rewrites. No text holds the "<" that must follow it, so none is tried twice.
_PLAIN = r"(?!\s++<)([?-\x{D7FF}'-;\x20-%=\t\n\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]*)"
_SPACE = r"[ \t\n]*+"
_FIELDS = "".join(f"(?:<{c}>{_PLAIN}</{c}>{_SPACE})?+" for c in COLUMNS)
_SIMPLE = rf"\A<enrollment>{_SPACE}{_FIELDS}</enrollment>\z"
# Such an element as a scan gives it: without its end tag, behind text that is no tag.
_CHUNK = rf"\A[^<]*+<enrollment>{_SPACE}{_FIELDS}\z"
_CUT = "\x01"  # no XML text holds it
_OWN = "_own_texts"  # of elements that a scan gave whole and that need no XML reader

# Letters that a cast reads in its own way: suffixes, hexadecimal, infinity.
_UNUSUAL = "[dDfFpPxX_]"


def _premium(text: Column) -> Column:
    """Absent or empty is 0; text that is no number gives null."""
    trimmed = strip(text)
    special = F.when(trimmed.rlike(SPECIAL_NUMBER), F.replace(trimmed, F.lit("_"), F.lit("")))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", 0.0)
        .when(~trimmed.rlike(_UNUSUAL), trimmed.try_cast("double"))
        .otherwise(special.try_cast("double"))
    )


def _cut(df: DataFrame, text: str, pattern: str, name: str, *keep: str) -> DataFrame:
    """``keep`` and, as ``name``, the texts of the columns where the pattern matches, else null."""
    places = "".join(f"{_CUT}${i + 1}" for i in range(len(COLUMNS)))
    cut = df.select("*", F.regexp_replace(text, pattern, places).alias("_cut"))
    # What is cut starts with a mark; text that does so already is none of XML.
    matched = F.startswith("_cut", F.lit(_CUT)) & ~F.startswith(text, F.lit(_CUT))
    return cut.select(*keep, F.when(matched, F.split("_cut", _CUT, -1)).alias(name))


def elements_of(chunks: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``raw``, the text of each element, of chunks of XML text in ``value``.

    A chunk is what stands before an end tag of an element. All of its start tags but the last lack
    their end tag, so damage stays within an element. An empty element tag gives nothing. A chunk that
    is one plain element stays as it is, with its texts beside it.
    """
    pieces = F.split(F.regexp_replace("value", rf"\A(?s:.*?)({_START}|\z)", "$1"), f"(?={_START})")
    cut = _cut(chunks, "value", _CHUNK, _OWN, *keep, "value")
    plain = F.col(_OWN).isNotNull()
    placed = cut.select("*", F.when(~plain, pieces).alias("_pieces"))
    filled = F.filter("_pieces", lambda x: x.rlike(rf"\A{_START}") & ~x.rlike(r"\A<enrollment\s[^>]*/>"))
    last = F.element_at("_pieces", -1)
    closed = F.transform(filled, lambda x: F.when(x == last, F.concat(x, F.lit(_END))).otherwise(x))
    listed = F.when(plain, F.array("value")).otherwise(closed)
    return placed.select(*keep, _OWN, F.explode(listed).alias(RAW_RECORD))


def _read(elements: DataFrame) -> DataFrame:
    """``elements`` with their texts in ``_e``; an absent text may be empty.

    Elements of plain texts in the order of the columns are cut by one pattern, as an XML reader costs
    many times that; all others are read as XML. Texts that ``elements_of`` cut are taken.
    """
    schema = f"{string_columns(COLUMNS)}, {UNREADABLE} string"
    options = {
        "ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": UNREADABLE, "rowTag": "enrollment",
    }
    own = F.col(_OWN) if _OWN in elements.columns else F.lit(None).cast("array<string>")
    rest = elements.select("*", F.when(own.isNull(), F.col(RAW_RECORD)).alias("_rest"))
    cut = _cut(rest, "_rest", _SIMPLE, "_cut_here", *rest.columns)
    cut = cut.withColumn("_texts", F.coalesce(own, "_cut_here"))
    # The first is what stands before the first mark.
    texts = [F.get("_texts", F.lit(i + 1)).alias(c) for i, c in enumerate(COLUMNS)]
    plain = F.struct(*texts, F.lit(None).cast("string").alias(UNREADABLE))
    read = F.when(F.col("_texts").isNotNull(), plain).otherwise(F.from_xml("_rest", schema, options))
    return cut.select(*elements.columns, read.alias("_e"))


def parse_enrollments(elements: DataFrame, *keep: str) -> DataFrame:
    """Typed columns of the elements in ``raw_record``, and an error where one is unusable."""
    raw, behind = F.col(RAW_RECORD), [RAW_RECORD]
    if _OWN in elements.columns:
        whole = F.concat(F.regexp_replace(RAW_RECORD, r"\A[^<]*+", ""), F.lit(_END))
        raw = F.when(F.col("_plain"), whole).otherwise(raw)
        behind.append(F.col(_OWN).isNotNull().alias("_plain"))
    read = _read(elements)
    text = {c: F.col(f"_e.{c}") for c in COLUMNS}
    typed = read.select(
        *keep,
        *[F.coalesce(strip(text[c]), F.lit("")).alias(c) for c in TEXTS],
        *[_premium(text[c]).alias(c) for c in PREMIUMS],
        "_e", *behind,
    )
    errors = [
        F.when(F.col("_e").isNull() | F.col(f"_e.{UNREADABLE}").isNotNull(), BAD_ELEMENT),
        F.when(F.col("employee_id") == "", "empty employee_id"),
    ]
    for c in PREMIUMS:
        message = F.concat(F.lit("could not convert string to float: '"), text[c], F.lit("'"))
        errors.append(F.when(F.col(c).isNull(), message))
    error = F.coalesce(*errors)
    return typed.select(
        *keep, *COLUMNS, error.alias(ERROR), F.when(error.isNotNull(), raw).alias(RAW_RECORD)
    )


def parse_benefits_xml(spark: SparkSession, path: str) -> DataFrame:
    """Enrolments with ordinals and errors. Store the result, then ``split_rejects`` it.

    Files are split between tasks at the end tags of elements, and every element is parsed by
    itself. An error keeps the element as it came; one that has no end tag reaches to the next start
    tag, or to the end of the file, and there gets the end tag that it lacks.
    """

    def scan() -> DataFrame:
        return spark.read.option("lineSep", _END).text(path).select("value", file_of_scan())

    chunks = read_or_empty(spark, scan, f"value string, {FILE} string")
    elements = with_ordinal(elements_of(chunks, FILE))
    return parse_enrollments(elements, FILE, "ingest_ordinal")


def expected_elements(spark: SparkSession, path: str) -> DataFrame:
    """``file, expected``: start tags of elements that are not empty element tags."""

    def scan() -> DataFrame:
        chunks = spark.read.option("lineSep", _END).text(path)
        # Only a start tag with something behind its name can be an empty element tag.
        empty = F.regexp_count("value", F.lit(r"<enrollment\s[^>]*/>"))
        empty = F.when(F.col("value").rlike(r"<enrollment\s"), empty).otherwise(0)
        found = F.regexp_count("value", F.lit(_START)) - empty
        return chunks.select(file_of_scan(), found.cast("long").alias("expected"))

    found = read_or_empty(spark, scan, f"{FILE} string, expected long")
    return found.groupBy(FILE).agg(F.sum("expected").alias("expected"))
