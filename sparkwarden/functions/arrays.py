"""List-valued cells that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EMPTY = "array<string>"


# White space of all scripts, at both ends.
_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _BLANKS, "")


def _clean(items: Column) -> Column:
    return F.filter(F.transform(items, strip), lambda x: x.isNotNull() & (x != ""))


def _element(value: Column) -> Column:
    """A list element as text; constants have the spelling that the original gives them."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    constant = F.when(kind == "BOOLEAN", F.initcap(text)).when(kind == "VOID", "None")
    return F.coalesce(constant, text, F.to_json(value))


def _json_list(text: Column) -> Column:
    """The elements of a text that is one JSON list and nothing else, or null.

    The parser stops after the first value. Inside brackets and inside braces, text left over breaks the document.
    """
    first = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$[0]", "array<variant>")
    whole = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    return F.when(text.startswith("[") & text.endswith("]") & whole, F.transform(first, _element))


def list_from_text(cell: Column) -> Column:
    """A JSON list, else parts between ``|``, else between ``,``, else the cell alone; blanks dropped."""
    text = strip(cell)
    parsed = _json_list(text)
    parts = F.when(text.contains("|"), F.split(text, r"\|")).otherwise(F.split(text, ","))
    return F.coalesce(_clean(F.coalesce(parsed, parts)), F.array().cast(_EMPTY))


def clean_list(items: Column) -> Column:
    """Trimmed elements without blanks; a null list is empty."""
    return F.coalesce(_clean(items), F.array().cast(_EMPTY))


def flat_tokens(nested: Column) -> Column:
    """All tokens of a list of lists, in order; text elements that hold several are taken apart."""
    whole = F.flatten(F.filter(nested, lambda x: x.isNotNull()))
    pieces = F.flatten(F.transform(whole, list_from_text))
    return F.coalesce(pieces, F.array().cast(_EMPTY))


def text_tokens(items: Column) -> Column:
    """The same for a plain list of text."""
    return F.coalesce(F.flatten(F.transform(items, list_from_text)), F.array().cast(_EMPTY))


def or_empty(items: Column) -> Column:
    return F.coalesce(items, F.array().cast(_EMPTY))
