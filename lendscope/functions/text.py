"""Text templates and text clean-up as Column expressions."""

from __future__ import annotations

import operator
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendscope import fixed


def fill_sql(template: str, **fields: str) -> str:
    """SQL text that puts expressions into ``{name}`` places; NULL when any of them is NULL."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [
        f"CAST({fields[part]} AS STRING)" if place % 2 else "'" + part.replace("'", "\\'") + "'"
        for place, part in enumerate(parts)
        if place % 2 or part
    ]
    return f"concat({', '.join(pieces)})"


def fill(template: str, **fields: str) -> Column:
    return F.expr(fill_sql(template, **fields))


def or_missing(value: str, otherwise: str = fixed.MISSING) -> str:
    """SQL text of a value as a string, or of a word for NULL."""
    return f"coalesce(CAST({value} AS STRING), '{otherwise}')"


def preview(value: Column, length: int = fixed.PREVIEW_LENGTH) -> Column:
    return F.concat(F.left(value, F.lit(length)), F.lit("..."))


def clean_reply(value: Column) -> Column:
    """Turn literal backslash-n and backslash-t of a model reply into real breaks and tabs."""
    text = F.coalesce(value, F.lit("No response generated."))
    text = F.replace(text, F.lit("\\n"), F.lit("\n"))
    return F.replace(text, F.lit("\\t"), F.lit("\t"))


# Markup that carries no text, then entities, in the order they are applied.
_NON_TEXT = (
    r"(?is)<script\b.*?</script>",
    r"(?is)<style\b.*?</style>",
    r"(?s)<!--.*?-->",
    r"(?s)<[^>]*>",
)
_ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
)


def unescape(value: Column) -> Column:
    for entity, character in _ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(character))
    return value


def squeeze(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"[ \t\r\n]+", " "))


def markup_text(html: Column) -> Column:
    """Readable text of an HTML document."""
    for pattern in _NON_TEXT:
        html = F.regexp_replace(html, pattern, " ")
    return squeeze(unescape(html))


def markup_title(html: Column) -> Column:
    title = F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1)
    return F.nullif(squeeze(unescape(title)), F.lit(""))


def route_words(text: Column | str, words: tuple) -> Column:
    """True when any of the words occurs anywhere in the lower-cased text."""
    lowered = F.lower(text)
    return F.coalesce(reduce(operator.or_, [lowered.contains(word) for word in words]), F.lit(False))
