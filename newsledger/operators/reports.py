"""Report tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsledger.functions.reports import report_lines as lines_of
from newsledger.functions.reports import report_text

MAX_WIDTH = 50


def report_rows(*tables: DataFrame) -> DataFrame:
    """All rows with the union of the columns, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def rows_of_objects(rows: DataFrame, column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and one column per key of the VARIANT objects in ``column``, in order of the keys; missing ones null.

    The keys and their types are found in one aggregation over all rows (by key, combined map-side). Booleans, numbers, dates and times keep
    the widest type that a key has; keys with mixed or nested values become text, nested ones as JSON. A null row or one that is no
    object has null in every column; no object at all gives ``keep`` alone. A name that is taken already, also in other case, gets a number.
    """
    fields = F.col(column).try_cast("map<string, variant>")
    found = rows.select(F.explode(fields).alias("key", "value")).groupBy("key").agg(F.schema_of_variant_agg("value").alias("type"))
    taken, columns = {c.lower() for c in keep}, []
    for key, kind in sorted(found.collect()):
        name, number = key, 1
        while name.lower() in taken:
            number += 1
            name = f"{key}_{number}"
        taken.add(name.lower())
        plain = not kind.startswith(("OBJECT", "ARRAY", "VARIANT", "VOID"))
        value = F.try_element_at(F.col("__fields"), F.lit(key))
        columns.append(value.cast(kind if plain else "string").alias(name))
    return rows.select(*keep, fields.alias("__fields")).select(*keep, *columns)


def write_report(report: DataFrame, path: str, file_format: str = "csv") -> bool:
    """Writes a new report folder; an empty report writes nothing and gives ``False``."""
    if report.isEmpty():
        return False
    writer = report.write.mode("errorifexists")
    (writer.option("header", True) if file_format == "csv" else writer).format(file_format).save(path)
    return True


def column_widths(report: DataFrame, max_width: int = MAX_WIDTH) -> DataFrame:
    """``(column_name, width)``: longest text of the column or name length + 2, at most ``max_width``.
    A null counts as the four letters ``None``. One aggregation over all columns."""
    longest = report.agg(
        *[
            F.max(F.length(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("None")))).alias(f"w{i}")
            for i, c in enumerate(report.columns)
        ]
    )
    widths = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.least(F.greatest(F.coalesce(f"w{i}", F.lit(0)), F.lit(len(c) + 2)), F.lit(max_width)).alias(
                    "width"
                ),
            )
            for i, c in enumerate(report.columns)
        ]
    )
    return longest.select(F.inline(widths))


def report_line_rows(report: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, line_no, line)``: the lines of every row of a report having any of the columns title,
    name, summary and content."""

    def column(name: str):
        return F.col(name) if name in report.columns else F.lit(None).cast("string")

    whole = F.to_json(F.struct(*report.columns))
    text = report_text(column("title"), column("name"), column("summary"), column("content"), whole)
    return report.select(*keys, F.posexplode(lines_of(text)).alias("line_no", "line"))
