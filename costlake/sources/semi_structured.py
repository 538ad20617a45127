"""2.13: usage lines that arrive as JSON texts, read through the VARIANT type.

A text is parsed once (``try_parse_json``); typed columns are taken from it by path.
A text that is no JSON, or a value of the wrong kind, does not fail the job: its
row goes to the rejected frame with the fields that could not be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.session import materialize


def typed_variant(rows: DataFrame, text: str, paths: dict[str, tuple[str, str]], optional: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` without ``text``, with a column per entry of ``paths`` (name -> path,
    kind) and ``problem``: ``no JSON``, the names of required values that are
    absent and of any value of another kind (comma-joined), or NULL."""
    v = F.col("_v")
    parsed = rows.withColumn("_v", F.try_parse_json(text))

    def value(path: str, kind: str) -> Column:
        """Of a text only as text, and only a text as text: no kind is cast to another."""
        is_text = F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING"
        return F.when(is_text if kind == "string" else ~is_text, F.try_variant_get(v, path, kind))

    def bad(name: str, path: str, kind: str) -> Column:
        wrong = value(path, kind).isNull()
        if name in optional:
            raw = F.try_variant_get(v, path, "variant")
            wrong = wrong & raw.isNotNull() & ~F.is_variant_null(raw)
        return F.when(wrong, F.lit(name))

    problem = F.concat_ws(",", *[bad(n, p, k) for n, (p, k) in paths.items()])
    kept = [c for c in rows.columns if c != text and c not in paths and c != "problem"]
    return parsed.select(*kept, *[value(p, k).alias(n) for n, (p, k) in paths.items()],
                         F.when(v.isNull(), F.lit("no JSON")).otherwise(F.nullif(problem, F.lit(""))).alias("problem"))


USAGE_PATHS = {
    "id": ("$.line.id", "string"), "usage_date": ("$.line.day", "string"), "product_code": ("$.product.code", "string"),
    "usage_type": ("$.product.types[0]", "string"), "cost": ("$.cost", "decimal(18,2)"),
}


def usage_from_json(rows: DataFrame, text: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) usage lines of JSON texts; only the cost may be absent. The typed
    rows are stored once, so that a text is parsed once for both frames."""
    read = materialize(typed_variant(rows, text, USAGE_PATHS, optional=("cost",)))
    return read.filter("problem IS NULL").drop("problem"), read.filter("problem IS NOT NULL")
