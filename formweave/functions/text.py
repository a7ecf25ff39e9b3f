"""Text rules as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from formweave.functions.binding import let

# The characters counted as white space (all scripts', and the
# four separators Java leaves out), the marks that end a sentence and those that
# end a clause.
SPACE = r"(?U:[\s\x1C-\x1F])"
NON_SPACE = r"(?U:[^\s\x1C-\x1F])"
SENTENCE_END = "[。！？!?]"
CLAUSE_END = "[，,]"


def strip(text: Column) -> Column:
    """Cut white space of any script from both ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column) -> Column:
    return ~text.rlike(NON_SPACE)


def drop_blank(items: Column) -> Column:
    """Items holding more than white space, unchanged."""
    return F.filter(items, lambda x: ~is_blank(x))


def raw_paragraphs(text: Column) -> Column:
    """Pieces between blank lines, not stripped, empty ones included."""
    return F.split(text, f"\\n{SPACE}*\\n")


def paragraphs(text: Column, separator: str | None = None) -> Column:
    """Paragraphs between blank lines, stripped, blank ones dropped.

    ``separator`` is a pattern to split on instead, for texts whose
    paragraphs are single lines.
    """
    pieces = F.split(text, separator or f"\\n{SPACE}*\\n+")
    return F.filter(F.transform(pieces, strip), lambda p: p != "")


def sentences(text: Column) -> Column:
    """Sentences with their end mark; a full stop ends none."""
    return drop_blank(F.split(text, f"(?<={SENTENCE_END})"))


def clauses(text: Column) -> Column:
    """Clauses with their comma."""
    return drop_blank(F.split(text, f"(?<={CLAUSE_END})"))


def hard_cut(text: Column, size: int) -> Column:
    """Consecutive pieces of ``size`` characters, the last one shorter."""
    # One pass; substring() would count from the start for every piece.
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def fence(text: Column) -> Column:
    """A Markdown code block around plain text."""
    return F.concat(F.lit("```text\n"), text, F.lit("\n```"))


def unbold(text: Column) -> Column:
    """**x** becomes x."""
    return F.regexp_replace(text, r"\*\*(.+?)\*\*", "$1")


def preview(text: Column, size: int = 100) -> Column:
    """The head of a text for a hit list."""
    return F.substring(text, 1, size)


def clean(text: Column) -> Column:
    """Drop control and replacement characters, squeeze spaces."""
    printable = F.regexp_replace(text, "[\\x00-\\x08\\x0E-\\x1F\\x7F\\uFFFD\\uFEFF]", "")
    squeezed = F.regexp_replace(printable, "[ \\t\\u00A0\\u3000]+", " ")
    return strip(F.regexp_replace(squeezed, " ?\\r?\\n ?", "\n"))


def render(template: Column, values: dict[str, Column]) -> Column:
    """Put values into {{ name }} places; a null value leaves nothing."""
    if not values:
        return template
    for name in values:
        # An escaped name could not hold \E, so none is accepted.
        if "\\E" in name:
            raise ValueError(f"bad field name {name!r}")
    place = "\\{\\{\\s*(" + "|".join(f"\\Q{name}\\E" for name in values) + ")\\s*\\}\\}"
    texts = F.create_map(*[x for n, v in values.items() for x in (F.lit(n), F.coalesce(v.cast("string"), F.lit("")))])
    # The template is cut once, so a place inside a value stays text.
    return let(
        texts,
        lambda held: F.array_join(
            F.zip_with(
                F.split(template, place),
                F.transform(F.regexp_extract_all(template, F.lit(place), F.lit(1)), lambda name: F.element_at(held, name)),
                lambda literal, value: F.concat(literal, F.coalesce(value, F.lit(""))),
            ),
            "",
        ),
    )


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """The last suffix with its dot, lower case, or ''."""
    return F.lower(F.regexp_extract(file_name(path), r"(?<=.)(\.[^.]+)$", 1))


def with_suffix(path: Column, new: str) -> Column:
    return F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", ""), F.lit(new))


def relative_to(path: Column, root: str) -> Column:
    return F.substring(path, len(root.rstrip("/")) + 2, 1 << 30)


def join_cells(cells: Column) -> Column:
    """One table row as Markdown, null cells empty."""
    return F.concat(F.lit("| "), F.array_join(cells, " | ", ""), F.lit(" |"))


def divider(width: Column) -> Column:
    """The Markdown line under a table header."""
    return F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit(" --- "), width), "|"), F.lit("|"))


def words(text: Column) -> Column:
    """Tokens between white space."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


# Fixed value: the block of common Han characters.
_HAN = "\\u4E00-\\u9FFF"


def words_and_bigrams(text: Column) -> Column:
    """Words of spaced scripts and two-character windows over Han runs."""
    runs = F.regexp_extract_all(text, F.lit(f"[{_HAN}]+|[^{_HAN}\\s]+"), F.lit(0))

    def tokens(run: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(run) - 1, F.lit(1))),
            lambda i: F.substring(run, i, F.lit(2)),
        )
        return F.when(run.rlike(f"^[{_HAN}]"), pairs).otherwise(F.array(run))

    return F.flatten(F.transform(runs, tokens))


def any_filled(columns: Sequence[Column]) -> Column:
    """True when some value is neither null nor '' (P12)."""
    return F.exists(F.array(*columns), lambda v: v.isNotNull() & (v != ""))


def first_filled(columns: Sequence[Column], default: str = "?") -> Column:
    """The first value that is neither null nor '' (A13)."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(default))
