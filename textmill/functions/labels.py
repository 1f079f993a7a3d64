"""Label expressions: label lines and numeric labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only label that does not count as destructive.
NORMAL_LABEL = "__label__NORMAL"
# Python's idea of a blank: Unicode white space and the four separator controls.
_BLANK = r"[\s\x1c-\x1f]"


def strip_blanks(line: Column) -> Column:
    return F.regexp_replace(line, rf"(?U)^{_BLANK}+|{_BLANK}+$", "")


def line_is_destructive(line: Column) -> Column:
    """1 when any of the comma-separated labels before the first space is not NORMAL."""
    head = F.split(line, " ", 2).getItem(0)
    return F.when(head.rlike(f"^{NORMAL_LABEL}(,{NORMAL_LABEL})*$"), 0).otherwise(1)


def line_text(line: Column) -> Column:
    """What follows the first space, or an empty text."""
    return F.coalesce(F.get(F.split(line, " ", 2), F.lit(1)), F.lit(""))


def numeric_label(label: Column) -> Column:
    """The label as a double; null unless it is a number."""
    number = label.try_cast("double")
    return F.when(~F.isnan(number), number)
