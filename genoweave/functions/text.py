"""Text helpers for labels, lists in cells and raw lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_brackets(text: Column) -> Column:
    return F.regexp_replace(text, r"[()\[\]]", "")


def strip_commas(text: Column) -> Column:
    return F.regexp_replace(text, ",", "")


def quoted(text: Column) -> Column:
    return F.concat(F.lit("'"), text, F.lit("'"))


def words(line: Column) -> Column:
    """Whitespace-separated tokens, ignoring blanks at both ends."""
    return F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ")


def list_entry(value: Column) -> Column:
    """One entry of a list text: quoted as `'a'`, or as `"it's"` where that needs no escape; NULL is `None`.

    Backslashes, line feeds, carriage returns and tabs are escaped, and so is the quote where both kinds occur.
    """
    text = value
    for plain, escaped in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    other = value.contains("'") & ~value.contains('"')
    single = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(value.isNull(), "None").when(other, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(single)


def list_text(values: Column) -> Column:
    """An array as "['a', 'b']"; every entry can be read back by `text_list`."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, list_entry), ", "), F.lit("]"))


# The backslash comes first, or it would escape the others' escapes.
_ESCAPES = [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]
# An entry of a list text: either quote with escapes inside, or None.
_ENTRY = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|None"""


def _unescaped(entry: Column) -> Column:
    def part(text: Column) -> Column:
        for plain, escaped in [*_ESCAPES[1:], ("'", "\\'"), ('"', '\\"')]:
            text = F.replace(text, F.lit(escaped), F.lit(plain))
        return text

    # Escaped backslashes are split off first, so what follows one is no escape.
    inner = F.substring(entry, F.lit(2), F.length(entry) - 2)
    return F.array_join(F.transform(F.split(inner, r"\\\\"), part), "\\")


def text_list(text: Column) -> Column:
    """The array behind "['a', 'b']"; NULL if the text is no such list."""
    inner = F.substring(text, F.lit(2), F.length(text) - 2)
    entries = F.regexp_extract_all(inner, F.lit(_ENTRY), F.lit(0))
    whole = text.startswith("[") & text.endswith("]") & (F.array_join(entries, ", ") == inner)
    values = F.transform(entries, lambda e: F.when(e != "None", _unescaped(e)))
    return F.when(whole & (F.length(text) > 2), values).when(text == "[]", F.array().cast("array<string>"))


def gene_label(*parts: Column) -> Column:
    """'gene | rsids', NULL if a part is NULL."""
    spaced = [p for part in parts for p in (F.lit(" | "), part)][1:]
    return F.concat(*spaced)
