"""Text expressions shared by prompts, alerts and classification."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cut(text: Column | str, length: int | None) -> Column:
    """The first `length` characters, or all of the text without a length."""
    return _col(text) if length is None else F.substring(_col(text), 1, length)


def fixed(number: Column | str, digits: int = 1) -> Column:
    """Decimal text with a fixed number of digits, halves rounded up."""
    return F.format_string(f"%.{digits}f", _col(number).cast("double"))


def title(snake: Column | str) -> Column:
    """`data_issue` becomes `Data Issue`."""
    return F.initcap(F.replace(_col(snake), F.lit("_"), F.lit(" ")))


def yes_no(flag: Column | str) -> Column:
    """`Yes` for true, `No` for false and null."""
    return F.when(_col(flag), F.lit("Yes")).otherwise(F.lit("No"))


def lookup(key: Column | str, table: Mapping[str, object], default: object) -> Column:
    """Value of a fixed table for `key`, or `default`."""
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(key)), F.lit(default))


def error_class(message: Column | str) -> Column:
    """Last part of the exception name a message begins with, else `Unknown`."""
    name = F.regexp_extract(_col(message), r"^(?:\w+\.)*(\w+):", 1)
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit("Unknown")).otherwise(name)


def safe_id(run_id: Column | str, length: int | None = None) -> Column:
    """Run id in the form a cluster resource name allows.

    With a `length` a longer id keeps its beginning and gets 8 hex digits of its MD5, so that ids stay different.
    """
    name = F.lower(F.translate(_col(run_id), ":+", "--"))
    if length is None:
        return name
    short = F.concat(F.substring(name, 1, length - 9), F.lit("-"), F.substring(F.md5(name.cast("binary")), 1, 8))
    return F.when(F.length(name) <= length, name).otherwise(short)


def signature(message: Column | str) -> Column:
    """Error text with the parts that differ from one incident to the next replaced by placeholders."""
    text = _col(message)
    for pattern, mark in (
        (r"0x[0-9a-fA-F]+", "<hex>"),
        (r"(/[A-Za-z0-9_.\-]+)+", "<path>"),
        (r"[0-9]+", "<n>"),
        (r"\s+", " "),
    ):
        text = F.regexp_replace(text, pattern, mark)
    return F.lower(F.trim(text))
