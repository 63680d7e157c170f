"""Surrogate keys and object names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker hashed in place of NULL and the legal shape of a table name.
NULL_KEY_MARKER = "_dbt_utils_surrogate_key_null_"
NAME_SHAPE = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*(\.[A-Za-z_][A-Za-z0-9_$]*)*")


def surrogate_key(*fields: str | Column) -> Column:
    """MD5 over the fields as text, joined by ``-``, with NULLs replaced by a marker."""
    parts = [
        F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit(NULL_KEY_MARKER))
        for f in fields
    ]
    return F.md5(F.concat_ws("-", *parts))


def checked_name(name: str) -> str:
    """The name itself if it is a plain, possibly dotted, identifier; ValueError otherwise."""
    if NAME_SHAPE.fullmatch(name) is None:
        raise ValueError(f"not a valid object name: {name!r}")
    return name


def is_legal_name(name: Column) -> Column:
    """The same test on a column of names."""
    return name.rlike(rf"^(?:{NAME_SHAPE.pattern})\z")


def quoted_name(name: str) -> str:
    return ".".join(f"`{part}`" for part in checked_name(name).split("."))


def layer_name(custom: str | None, default: str) -> str:
    """Schema naming rule: a custom schema is trimmed and upper-cased, else the default holds."""
    return default if custom is None else custom.strip().upper()
