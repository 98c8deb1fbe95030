"""JSON text in and out, and identifiers by name."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_fields(text: str | Column, fields: Mapping[str, str]) -> dict[str, Column]:
    """Columns by name -> ``"path type"`` (such as ``"$.a.b bigint"``) out of JSON text.

    The text is parsed once into a VARIANT, whatever its shape; text that is no
    JSON, a missing path and a value that is no such type give NULL.
    """
    value = F.try_parse_json(F.col(text) if isinstance(text, str) else text)
    out = {}
    for name, rule in fields.items():
        path, kind = rule.rsplit(" ", 1)
        out[name] = F.try_variant_get(value, path, kind)
    return out


def json_kind(text: str | Column) -> Column:
    """Schema of JSON text as Spark names it (``OBJECT<k: BIGINT>``), NULL for text that is no JSON."""
    return F.schema_of_variant(F.try_parse_json(F.col(text) if isinstance(text, str) else text))


def struct_text(*columns: str | Column) -> Column:
    """The columns as one JSON object, in their order; NULL fields are written as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def joined_texts(items: str | Column, mark: str = "; ") -> Column:
    """An array of structs as JSON objects in one text, in the array's order."""
    items = F.col(items) if isinstance(items, str) else items
    return F.array_join(F.transform(items, lambda x: F.to_json(x, {"ignoreNullFields": "false"})), mark)


def name_uuid(name: str | Column, space: uuid.UUID = uuid.NAMESPACE_URL) -> Column:
    """UUID of a name in a name space (version 5): the same name has the same one in every run; NULL for NULL."""
    name = F.col(name) if isinstance(name, str) else name
    digest = F.sha1(F.concat(F.lit(bytearray(space.bytes)), F.encode(name.cast("string"), "UTF-8")))
    part = lambda at, n: F.substring(digest, at, n)
    # the top bits of the clock part say which layout this is: 10xx
    layout = F.lower(F.hex(F.conv(part(17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    dash = F.lit("-")
    return F.concat(part(1, 8), dash, part(9, 4), dash, F.lit("5"), part(14, 3), dash, layout, part(18, 3), dash, part(21, 12))
