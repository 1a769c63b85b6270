"""Stored-lot reader (S11): lenient JSON documents of the target system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotguard.functions.constants import STORED_COLUMNS

_SCHEMA = "struct<" + ",".join(f"{c}:string" for c in STORED_COLUMNS + ("numero",)) + ">"


def parse_stored(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """Each document is a JSON array; its objects are records, its other
    elements are passed over one by one. Anything else (an object, invalid
    text) yields no rows. Fields default to '', lote_id falls back to numero.
    All values are strings. ``position`` is an object's place in its list (the
    list is newest first); ``doc_id`` is kept if there is that column."""
    is_array = F.coalesce(F.ltrim(F.col(raw)).startswith("["), F.lit(False))
    elements = F.when(is_array, F.from_json(F.col(raw), "array<string>", {"mode": "PERMISSIVE"}))
    keys = ["doc_id"] if "doc_id" in docs.columns else []
    texts = docs.select(*keys, F.posexplode(elements).alias("position", "e")).where(F.ltrim("e").startswith("{"))
    rows = texts.select(*keys, "position", F.from_json("e", _SCHEMA, {"mode": "PERMISSIVE"}).alias("r")).where("r is not null").select(*keys, "position", "r.*")
    out = []
    for c in STORED_COLUMNS:
        if c == "lote_id":
            out.append(F.coalesce("lote_id", "numero", F.lit("")).alias(c))
        else:
            out.append(F.coalesce(c, F.lit("")).alias(c))
    return rows.select(*out, *keys, "position")
