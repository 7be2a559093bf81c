"""Whitespace, names, e-mail and small lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterweave.config import EMAIL_PATTERN

# Unicode whitespace; `trim` alone removes only the space character.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Private-use character: marks the word breaks that are added for initcap and taken out again.
_BREAK = "\ue000"


def strip(c: Column) -> Column:
    """Take Unicode whitespace off both ends.

    Text that starts and ends with a visible ASCII character, nearly all of it, is told by two
    comparisons and kept; trimming a set of characters is several times slower.
    """
    starts_visible = (c >= "!") & (c < "\x7f")
    ends_visible = F.substring(c, -1, 1).between("!", "~")
    return F.when(starts_visible & ends_visible, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def present(c: Column) -> Column:
    """Neither null nor blank."""
    return c.isNotNull() & (strip(c.cast("string")) != "")


def missing_as_null(c: Column, missing: list[str]) -> Column:
    return F.when(~c.isin(missing), c)


def compose_accents(c: Column) -> Column:
    """Unicode NFC. Text below U+0300 is composed already and is passed through."""
    # ICU ships with Spark, so no row leaves the JVM.
    composed = F.java_method(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False)
    )
    return F.when(c.rlike("[^\\u0000-\\u02FF]"), composed).otherwise(c)


def name_case(text: Column) -> Column:
    """Capitalise every part between spaces, hyphens and apostrophes, and after Mc and Mac.

    ``initcap`` starts words at spaces only, so a marked break is put after each hyphen,
    apostrophe and Mc/Mac prefix that has more letters, and is removed afterwards. Names without
    any of these skip that. Everything is a built-in with code generation. The text is stripped.
    """
    low = F.lower(text)
    plain = ~(
        F.contains(low, F.lit("-"))
        | F.contains(low, F.lit("'"))
        | F.contains(low, F.lit("mc"))
        | F.contains(low, F.lit("mac"))
    )
    broken = F.regexp_replace(text, "([-'])", "$1" + _BREAK + " ")
    broken = F.regexp_replace(broken, "(?i)(?<![^ ])(mc|mac)(?=[^ ])", "$1" + _BREAK + " ")
    cased = F.replace(F.initcap(broken), F.lit(_BREAK + " "), F.lit(""))
    return F.when(plain, F.initcap(text)).otherwise(cased)


def is_email(c: Column) -> Column:
    return c.rlike(EMAIL_PATTERN)


def lookup(c: Column, table: Mapping) -> Column:
    """Value for a key of a small fixed table, null when the key is not in it."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c) if pairs else F.lit(None)


def relabel(c: Column, table: Mapping[str, str]) -> Column:
    """Value for a key, or the key itself when the table does not have it."""
    return F.coalesce(lookup(c, table), c)


def slug(c: Column) -> Column:
    return F.translate(F.lower(c), " -", "__")


def full_name(first: Column, last: Column) -> Column:
    """Null if either part is null (``concat_ws`` would skip it)."""
    return F.concat(strip(first), F.lit(" "), strip(last))
