"""Text, path and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANKS = " \t\r\n"

# A comment, a whole script or style, or any tag. One pattern, so each page is read once.
BETWEEN_TEXTS = (
    r"(?s)<(?:!--.*?-->"
    r"|(?i:script)\b.*?</(?i:script)\s*>"
    r"|(?i:style)\b.*?</(?i:style)\s*>"
    r"|[^>]*>)"
)


def file_name(path: Column) -> Column:
    """Last part of a path."""
    return F.element_at(F.split(path, "/"), -1)


def file_stem(name: Column) -> Column:
    """File name without its last extension; a leading or trailing dot is no extension."""
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+\z", "")


def has_text(content: Column) -> Column:
    """False for NULL and ''; blanks count as text."""
    return F.coalesce(content != "", F.lit(False))


def iso_text(ts: Column) -> Column:
    """ISO form of a timestamp: no zone, six fraction digits or, when all are zero, none."""
    shown = F.translate(ts.cast("string"), " ", "T")
    whole_digits = len("2000-01-01T00:00:00.000000")
    return F.when(F.contains(shown, F.lit(".")), F.rpad(shown, whole_digits, "0")).otherwise(shown)


def percent_text(part: Column, whole: Column) -> Column:
    """``part / whole`` as a percentage with two decimals; NULL when ``whole`` is zero.

    Rounds the exact value of the double, ties to even. Formatting functions round its
    shortest decimal form instead, which shows 1 / 4000 as 0.02% rather than 0.03%.
    """
    share = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    halves = F.rint(share * 200)
    # 200 is split into powers of two so that no step rounds.
    beyond = (share * 128 - halves) + share * 64 + share * 8
    below = F.floor(halves / 2)
    hundredths = (
        F.when(F.pmod(halves, F.lit(2.0)) == 0, below)
        .when(beyond > 0, below + 1)
        .when(beyond < 0, below)
        .otherwise(below + F.pmod(below, F.lit(2)))
    )
    shown = F.format_string("%d.%02d%%", F.floor(hundredths / 100), F.pmod(hundredths, F.lit(100)))
    return F.when(share.isNotNull(), shown)


def line_elements(text: Column) -> Column:
    """Lines of a text."""
    return F.split(text, "\n", -1)


def markup_elements(html: Column) -> Column:
    """Texts between the tags of a marked-up page, in order, trimmed, blanks left out.

    Comments, scripts and styles separate texts just as tags do.
    """
    pieces = F.transform(F.split(html, BETWEEN_TEXTS, -1), lambda t: F.trim(t, F.lit(BLANKS)))
    return F.filter(pieces, lambda t: t != "")
