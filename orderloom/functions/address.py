"""Billing addresses: a JSON or Python-style object, stored as an encoded string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The address fields that are read.
ADDRESS_FIELDS = ["city", "pincode", "state"]

_OPTIONS = {"allowBackslashEscapingAnyCharacter": "true"}


def decode_address(text: Column) -> Column:
    """Struct of the address fields; missing or unreadable input gives NULL fields.

    The outer string is unwrapped by parsing it as a JSON value (single quotes are
    accepted), then the inner object is parsed. Nothing is ever evaluated as code.
    """
    wrapped = F.concat(F.lit('{"v":'), text, F.lit("}"))
    inner = F.from_json(wrapped, "v string", _OPTIONS)["v"]
    # Python writes a missing value as None, JSON as null.
    inner = F.regexp_replace(inner, r":\s*None(?=\s*[,}])", ": null")
    fields = ", ".join(f"{name} string" for name in ADDRESS_FIELDS)
    return F.from_json(inner, fields, _OPTIONS)


def is_rejected(text: Column, address: Column) -> Column:
    """True when there is address text but no field could be read from it."""
    unread = F.lit(True)
    for name in ADDRESS_FIELDS:
        unread = unread & address[name].isNull()
    return text.isNotNull() & unread
