"""Evidence cells: JSON of several shapes, or plain text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evigrade.functions.text import filled, strip

ITEM = "struct<source_type:string,title:string,url:string,text:string,evidence_id:string,confidence:string>"


def evidence_items(cell: Column | str) -> Column:
    """An array of items: {"items": []} is unwrapped, one object is one item, anything else is one text."""
    c = strip(filled(cell))
    array = F.coalesce(
        F.when(c.startswith("["), c),
        F.get_json_object(c, "$.items"),
        F.when(c.startswith("{") & F.try_parse_json(c).isNotNull(), F.concat(F.lit("["), c, F.lit("]"))),
    )
    parsed = F.from_json(array, f"array<{ITEM}>")
    plain = F.struct(
        F.lit("text").alias("source_type"),
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("url"),
        c.alias("text"),
        F.lit(None).cast("string").alias("evidence_id"),
        F.lit(None).cast("string").alias("confidence"),
    )
    none = F.array().cast(f"array<{ITEM}>")
    return F.when(c == "", none).otherwise(F.coalesce(parsed, F.array(plain)))
