"""JSON held in text: replies and lenient object lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from formweave.functions.text import strip

# Line ends as universal line splitting knows them.
_LINE_END = r"\r\n|[\n\x0B\f\r\x1C-\x1E\x85\u2028\u2029]"
_STRICT = {"allowSingleQuotes": "false"}


def strip_fence(reply: Column) -> Column:
    """The inside of a Markdown code block, or the stripped text."""
    text = strip(reply)
    lines = F.split(text, _LINE_END)
    inner = strip(F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 2, F.lit(0))), "\n"))
    return F.when(text.startswith("```") & (F.size(lines) >= 3), inner).otherwise(text)


def parse_object(text: Column) -> Column:
    """A JSON object as map<string,string>, or null for anything else.

    The text is parsed as the only item of a list: that way text after the
    object makes the list malformed instead of being ignored.
    """
    body = strip(text)
    items = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<map<string,string>>", _STRICT)
    return F.when(body.startswith("{") & (F.size(items) == 1), F.get(items, F.lit(0)))


def parse_objects(text: Column) -> Column:
    """Objects of a list, a single object or comma-joined objects.

    Gives array<map<string,string>>, empty when the text is broken.
    """
    body = strip(text)
    listed = F.when(body.startswith("["), body).otherwise(
        F.concat(F.lit("["), F.regexp_replace(body, ",+$", ""), F.lit("]"))
    )
    outer = F.from_json(
        F.concat(F.lit("["), listed, F.lit("]")), "array<array<map<string,string>>>", _STRICT
    )
    empty = F.array().cast("array<map<string,string>>")
    return F.coalesce(F.when(F.size(outer) == 1, F.get(outer, F.lit(0))), empty)


def parse_record_list(text: Column) -> Column:
    """As parse_objects, for files that must hold a list."""
    empty = F.array().cast("array<map<string,string>>")
    return F.when(strip(text).startswith("["), parse_objects(text)).otherwise(empty)
