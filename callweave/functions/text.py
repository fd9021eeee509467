"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_shape(token: Column, pattern: str) -> Column:
    return token.rlike(pattern)


def normalised(text: Column) -> Column:
    """Join key of a text: lower case, letters and digits only."""
    return F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]", "")


def clean_cell(text: Column) -> Column:
    """Newlines and quotes out; the whole text stays."""
    return F.regexp_replace(F.regexp_replace(text, "[\\r\\n]+", " "), "[\"']", "")


def letters_and_digits(text: Column) -> Column:
    """Anything but letters and digits becomes a blank."""
    return F.regexp_replace(text, "[^\\p{L}\\p{N}]", " ")


def first_name(name: Column) -> Column:
    return F.regexp_extract(name, "^\\s*(\\S+)", 1)


def last_name(name: Column) -> Column:
    return F.regexp_extract(name, "(\\S+)\\s*$", 1)


def bracketed_id(text: Column) -> Column:
    """Content of the last pair of brackets, null without one."""
    return F.nullif(F.regexp_extract(text, "\\(([^()]*)\\)[^()]*$", 1), F.lit(""))


def email_local(address: Column) -> Column:
    """Part before ``@`` and after the first ``-`` of it, if any."""
    local = F.split_part(address, F.lit("@"), F.lit(1))
    return F.when(local.contains("-"), F.regexp_extract(local, "^[^-]*-(.*)$", 1)).otherwise(local)
