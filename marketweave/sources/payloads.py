"""Rows out of landed JSON payloads, and landed JSON out of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.parsing import blank_to_null


def text_struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _as_list(text: Column) -> Column:
    """A JSON list text of a list or a single object; null for a blank or empty one."""
    body = F.btrim(text)
    return F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).when(body.startswith("[") & (body != "[]"), body)


def payload_rows(df: DataFrame, fields: T.StructType, column: str = "raw_data") -> DataFrame:
    """One row per payload row: ``output2``, else ``output``, each a list or an object, with the ``output1`` header.

    ``row_position`` is the row's place in its list, from 0. The document is parsed
    once, then the row list once and the header once.
    """
    others = [c for c in df.columns if c != column]
    parts = df.select(*others, F.from_json(column, text_struct("output1", "output2", "output")).alias("doc"))
    texts = parts.select(
        *others, _as_list(F.col("doc.output1")).alias("header_text"), F.coalesce(_as_list(F.col("doc.output2")), _as_list(F.col("doc.output"))).alias("row_text")
    )
    many = T.ArrayType(fields)
    header = F.get(F.from_json("header_text", many), F.lit(0))
    # the outer form keeps Spark from testing the parsed list in a filter, which would parse it again
    rows = texts.select(*others, header.alias("header"), F.posexplode_outer(F.from_json("row_text", many)).alias("row_position", "row"))
    return rows.where(F.col("row").isNotNull())


def parsed(df: DataFrame, column: str = "raw_data", into: str = "doc") -> DataFrame:
    """Adds ``into``: the payload as a VARIANT with all of its fields, known or not; null for text that is no JSON
    or, as VARIANT demands, names a field twice in one object.

    Fields are picked from it by :func:`field` and :func:`text_of`, however many, without parsing again.
    """
    return df.withColumn(into, F.try_parse_json(column))


def text_of(doc: Column | str, path: str) -> Column:
    """One field of a parsed payload as text; null if it is absent or JSON null."""
    return F.try_variant_get(doc, path, "string")


def field(name: str, doc: Column | str = "doc", *aliases: str) -> Column:
    """First non-blank of the nested field, the flat field and its aliases in a parsed payload."""
    paths = [f"$.response_row.{n}" for n in (name, *aliases)] + [f"$.{n}" for n in (name, *aliases)]
    return F.coalesce(*[blank_to_null(text_of(doc, p)) for p in paths])


def inner_or_whole(doc: str, path: str) -> Column:
    """The part of a parsed payload at ``path``, or the payload itself where that is absent or JSON null."""
    part = F.try_variant_get(doc, path, "variant")
    return F.when(part.isNotNull() & ~F.is_variant_null(part), part).otherwise(F.col(doc))


def keep_payload(df: DataFrame, source: Column, lineage: dict[str, Column] | None = None) -> DataFrame:
    """Adds ``raw_data``: the row itself as JSON with lineage fields next to it."""
    extra = [c.alias(n) for n, c in (lineage or {}).items()]
    return df.withColumn("raw_data", F.to_json(F.struct(F.struct(*df.columns).alias("response_row"), source.alias("source_label"), *extra)))
