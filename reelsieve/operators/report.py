"""Reports of small aggregates: nested JSON, CSV, Markdown, HTML with an SVG histogram."""

from __future__ import annotations

from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 10_000


def _rows(df: DataFrame) -> list:
    """The rows of an aggregate, which are few; a table of more than LIMIT rows isn't a report."""
    rows = df.limit(LIMIT + 1).collect()
    if len(rows) > LIMIT:
        raise ValueError(f"a report has at most {LIMIT} rows")
    return rows


def nested_json(df: DataFrame, outer: str, name: str, *inner: str) -> DataFrame:
    """outer and json: {outer, name: [{inner...}]} per outer value, sorted."""
    packed = F.array_sort(F.collect_list(F.struct(*inner)))
    return df.groupBy(outer).agg(packed.alias(name)).select(outer, F.to_json(F.struct(outer, name)).alias("json"))


def write_csv(df: DataFrame, path: str, blank: tuple[str, ...] = ()) -> None:
    """CSV with a header, and blank columns to be filled in by hand."""
    df.select("*", *[F.lit("").alias(b) for b in blank]).write.mode("overwrite").option("header", True).csv(path)


def markdown(df: DataFrame, title: str) -> str:
    rows = _rows(df)
    head = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([f"# {title}", "", *head, *["| " + " | ".join("" if x is None else str(x) for x in r) + " |" for r in rows]]) + "\n"


def svg_histogram(counts: list[int], width: int = 400, height: int = 120) -> str:
    top = max([1, *counts])
    bar = width / max(1, len(counts))
    boxes = "".join(f'<rect x="{i * bar:.1f}" y="{height * (1 - n / top):.1f}" width="{bar * 0.9:.1f}" height="{height * n / top:.1f}"/>' for i, n in enumerate(counts))
    return f'<svg width="{width}" height="{height}">{boxes}</svg>'


def _table(df: DataFrame) -> str:
    head = "".join(f"<th>{escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{escape('' if x is None else str(x))}</td>" for x in r) + "</tr>" for r in _rows(df))
    return f"<table><tr>{head}</tr>{body}</table>"


def _document(title: str, body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1>{body}</body></html>"


def html(df: DataFrame, title: str, counts: list[int] | None = None) -> str:
    return _document(title, (svg_histogram(counts) if counts else "") + _table(df))


def pages(title: str, sections: list[tuple[str, DataFrame]]) -> str:
    """One document with a heading and a table for each section."""
    return _document(title, "".join(f"<h2>{escape(name)}</h2>{_table(df)}" for name, df in sections))
