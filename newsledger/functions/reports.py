"""Text and template columns of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsledger.functions.text import let, strip

LINE_CHARS = 60
MAX_LINES = 5
UNNAMED = "未具名項目"  # fixed value: label of a row with neither title nor name


def report_text(title: Column, name: Column, summary: Column, content: Column, row: Column) -> Column:
    """``【label】: text`` of one row; label and text fall back as title, name, a fixed label and
    summary, content, the whole row."""
    return F.concat(
        F.lit("【"), F.coalesce(title, name, F.lit(UNNAMED)), F.lit("】: "),
        F.coalesce(summary, content, row),
    )


def report_lines(text: Column, width: int = LINE_CHARS, limit: int = MAX_LINES) -> Column:
    """The text cut into lines of ``width`` characters, at most ``limit`` of them; none for ''."""
    starts = F.array(*[F.lit(i * width + 1) for i in range(limit)])
    return let(
        text,
        lambda t: F.transform(
            F.filter(starts, lambda s: s <= F.length(t)), lambda s: F.substring(t, s, width)
        ),
    )


def template_cell(cell: Column, data: Column) -> Column:
    """A cell holding ``{{``: braces removed and trimmed it names a key; the whole cell becomes the
    key's value. Cells without ``{{`` or with an unknown key stay."""
    key = strip(F.replace(F.replace(cell, F.lit("{{"), F.lit("")), F.lit("}}"), F.lit("")))
    return F.when(cell.contains("{{") & F.map_contains_key(data, key), data[key]).otherwise(cell)


def template_text(text: Column, data: Column) -> Column:
    """Every exact ``{{key}}`` replaced by its value, key after key in the map's order."""
    filled = F.aggregate(
        F.map_entries(data),
        text,
        lambda acc, e: F.replace(
            acc, F.concat(F.lit("{{"), e["key"], F.lit("}}")), F.coalesce(e["value"], F.lit("None"))
        ),
    )
    return F.when(text.contains("{{"), filled).otherwise(text)


def template_file(name: Column) -> Column:
    """The last part of a path, so a template name cannot leave the template folder."""
    return F.regexp_extract(name, r"([^/]*)$", 1)


def template_route(name: Column, text: Column, data: Column) -> Column:
    """The fill rule by file suffix: sheets cell-wise, slides text-wise, anything else ''."""
    return (
        F.when(name.endswith(".xlsx"), template_cell(text, data))
        .when(name.endswith(".pptx"), template_text(text, data))
        .otherwise(F.lit(""))
    )
