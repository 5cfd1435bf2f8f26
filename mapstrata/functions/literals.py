"""Lists and dictionaries kept as text in metadata columns.

The text is written the Python way (single quotes, ``None``), so it is brought to JSON that
Spark parses: bare words are quoted or nulled and ``\\xNN`` escapes become ``\\u00NN``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_JSON_OPTIONS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true", "mode": "FAILFAST"}
_OPTIONS_SCHEMA = "struct<options:map<string,string>>"

# Quoted strings with their escapes, or what stands between them.
_TOKENS = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^'"]++|['"]"""


def _as_json(text: Column, outside: Callable[[Column], Column]) -> Column:
    """``outside`` applied between quoted strings only; in them ``\\xNN`` becomes ``\\u00NN``, unless its backslash is
    itself escaped."""

    def token(part: Column) -> Column:
        inside = F.regexp_replace(part, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
        return F.when(F.substring(part, 1, 1).isin("'", '"'), inside).otherwise(outside(part))

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0)), token), "")


def _words_quoted(part: Column) -> Column:
    return F.regexp_replace(part, r"\b(None|True|False)\b", r'"$1"')


def _parsed(text: Column, json: Column, schema: str) -> Column:
    """Text that is no literal fails the job; so does blank text."""
    blank = F.concat(F.lit("not a list or dictionary: "), text)
    return F.when(F.trim(text) == "", F.raise_error(blank).cast(schema)).otherwise(F.from_json(json, schema, _JSON_OPTIONS))


def list_from_text(text: Column) -> Column:
    """``"['SI ', 'NO']"`` or ``"[1, 2]"`` to an array of texts; ``None`` keeps its name."""
    return _parsed(text, _as_json(text, _words_quoted), "array<string>")


def options_from_text(text: Column) -> Column:
    """Map under key ``options`` of a dictionary text, null when the key is absent. Keys may be numbers."""

    def outside(part: Column) -> Column:
        nulled = F.regexp_replace(part, r"(:\s*)None\b", "$1null")
        keyed = F.regexp_replace(nulled, r"(^|[{,])(\s*)(-?\d+(?:\.\d+)?|None|True|False)(?=\s*:)", r'$1$2"$3"')
        return F.regexp_replace(keyed, r"(:\s*)(True|False)\b", r'$1"$2"')

    return _parsed(text, _as_json(text, outside), _OPTIONS_SCHEMA)["options"]


def _item_text(item: Column) -> Column:
    escaped = F.regexp_replace(item, r"\\", r"\\\\")
    with_apostrophe = F.instr(item, "'") > 0
    with_quote = F.instr(item, '"') > 0
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), escaped, F.lit('"'))
    return F.when(item.isNull(), "None").when(with_apostrophe & ~with_quote, double).otherwise(single)


def list_to_text(items: Column) -> Column:
    """Inverse of :func:`list_from_text`."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, _item_text), ", "), F.lit("]"))


def array_literal(items: Column) -> Column:
    """Database array text ``{a,b}``; quotes are dropped from the items."""
    return F.concat(F.lit("{"), F.array_join(F.transform(items, unquoted), ","), F.lit("}"))


def unquoted(item: Column) -> Column:
    return F.translate(item, "'\"", "")
