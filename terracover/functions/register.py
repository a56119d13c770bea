"""Names under which SQL texts can use the library's functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .geometry import from_wkb, interior_point, is_valid, to_wkb
from .text import _fold_table


def register(spark: SparkSession) -> list[str]:
    """Register temporary functions; the text ones are SQL expressions, so plans stay in codegen."""
    source, target = _fold_table()
    texts = {
        "squeeze_text": ("x STRING", "STRING", r"trim(regexp_replace(x, r'(?U)\s+', ' '))"),
        "fold_text": ("x STRING", "STRING", f"upper(translate(x, '{source}', '{target}'))"),
        "digits_of": ("x STRING", "STRING", r"regexp_replace(coalesce(x, ''), r'\D', '')"),
        "zero_fill": ("x STRING, width INT", "STRING", "CASE WHEN length(x) < width THEN lpad(x, width, '0') ELSE x END"),
        "number_br": ("x DOUBLE", "STRING", "replace(format_number(cast(x as bigint), 0), ',', '.')"),
    }
    for name, (arguments, kind, body) in texts.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    udfs = {"interior_point": interior_point, "is_valid_polygon": is_valid, "polygon_to_wkb": to_wkb, "polygon_from_wkb": from_wkb}
    for name, f in udfs.items():
        spark.udf.register(name, f)
    return [*texts, *udfs]
