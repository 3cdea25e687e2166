"""Previews, export frames, flattening and width statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from threadlens.functions.text import title_case
from threadlens.operators.reads import LATEST, latest, table_counts

# Column order of each exported sheet.
SHEETS = {
    "posts": ["post_id", "subreddit", "title", "body", "author", "score", "num_comments", "sentiment_label",
              "sentiment_score", "keywords", "url", "created_utc"],
    "comments": ["comment_id", "post_id", "parent_id", "author", "body", "score", "depth", "sentiment_label",
                 "sentiment_score", "keywords", "created_utc"],
    "qa_pairs": ["question_comment_id", "answer_comment_id", "post_id", "question", "answer", "score_signal",
                 "match_type", "verification_status", "confidence_score"],
}
# Preview columns with their default and the length shown.
PREVIEWS = {
    "posts": {"title": ("N/A", 70), "post_id": ("N/A", None), "subreddit": ("N/A", None), "score": (0, None),
              "num_comments": (0, None), "sentiment_label": ("neutral", None), "sentiment_score": (0.0, None),
              "keywords": ("", 50)},
    "comments": {"author": ("N/A", None), "post_id": ("N/A", None), "parent_id": ("N/A", None), "score": (0, None),
                 "depth": (0, None), "sentiment_label": ("neutral", None), "sentiment_score": (0.0, None),
                 "keywords": ("", 50), "body": ("N/A", 80)},
    "qa_pairs": {"post_id": ("N/A", None), "match_type": ("unverified", None),
                 "verification_status": ("unverified_best_effort", None), "confidence_score": (0.5, None),
                 "question": ("N/A", 80), "answer": ("N/A", 80)},
}
# Padding and bounds of a column width.
PADDING, MIN_WIDTH, MAX_WIDTH = 3, 12, 50


def statistics(posts: DataFrame, comments: DataFrame, qa_pairs: DataFrame) -> DataFrame:
    return table_counts(posts=posts, comments=comments, qa_pairs=qa_pairs)


def previews(df: DataFrame, table: str, n: int = 3) -> DataFrame:
    """Latest `n` rows with defaults, long texts cut for display."""
    cols = []
    for name, (default, width) in PREVIEWS[table].items():
        col = F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)
        cols.append((F.substring(col, 1, width) if width else col).alias(name))
    return latest(df, n, LATEST[table]).select(*cols)


def _plain(col: Column) -> Column:
    """A double as its shortest plain decimal; beyond 20 whole digits it keeps its exponent."""
    text = col.cast("string")
    digits = F.regexp_replace(text.try_cast("decimal(38,18)").cast("string"), r"(?<=\.\d)(\d*?)0+$", "$1")
    return F.when(F.contains(text, F.lit("E")), F.coalesce(digits, text)).otherwise(text)


def format_cell(col: Column, dtype: T.DataType) -> Column:
    """NULL as empty text, timestamps as YYYY-mm-dd HH:MM:SS, numbers in plain decimals, True or False, else as text."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        shown = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        shown = _plain(col)
    elif isinstance(dtype, T.BooleanType):
        shown = F.when(col, "True").when(~col, "False")
    else:
        shown = col.cast("string")
    return F.coalesce(shown, F.lit(""))


def format_cells(df: DataFrame) -> DataFrame:
    return df.select(*[format_cell(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested fields as top-level columns named parent + sep + child."""

    def leaves(schema: T.StructType, path: list[str]) -> list[Column]:
        out = []
        for field in schema.fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))
        return out

    return df.select(*leaves(df.schema, []))


def export_frame(df: DataFrame, table: str, limit: int | None = None, titles: bool = True) -> DataFrame:
    """Sheet columns in fixed order, formatted, under title headers; `limit` keeps the latest rows only."""
    if limit is not None:
        df = latest(df, limit, LATEST[table])
    flat = flatten_struct(df)
    sheet = flat.select(*[F.col(c) if c in flat.columns else F.lit("").alias(c) for c in SHEETS[table]])
    cells = format_cells(sheet)
    return cells.toDF(*[title_case(c) for c in cells.columns]) if titles else cells


def write_export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """One directory per sheet, written in parallel; CSV carries the header and quotes embedded line breaks."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(header=True, escape='"', quoteAll=True, **keep).csv(path)
    else:
        writer.format(fmt).save(path)


def column_widths(df: DataFrame) -> DataFrame:
    """column_name, width: longest shown text or header plus padding, within bounds; one pass over all columns."""
    longest = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        shown = format_cell(col, field.dataType)
        if isinstance(field.dataType, T.NumericType):
            shown = F.when(col == 0, "").otherwise(shown)  # a falsy cell shows nothing
        longest.append(F.max(F.length(shown)).alias(field.name))
    stats = df.agg(*longest)
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.least(
                F.greatest(F.coalesce(F.col(f"`{c}`"), F.lit(0)) + PADDING, F.lit(len(c) + PADDING), F.lit(MIN_WIDTH)),
                F.lit(MAX_WIDTH),
            ).alias("width"),
        )
        for c in df.columns
    ])
    return stats.select(F.inline(rows))


def export_summary(**sheets: DataFrame) -> DataFrame:
    """Rows per sheet."""
    return table_counts(**sheets).withColumnRenamed("table_name", "sheet")
