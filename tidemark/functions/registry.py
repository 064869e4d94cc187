"""SQL names for the column functions; all but one are inlined by the optimizer."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from tidemark.functions.scoring import DELTA_THRESHOLD

SQL_FUNCTIONS = {
    "materiality": (
        "delta DOUBLE, chunk_count BIGINT", "DOUBLE", "abs(delta) * log1p(chunk_count)"
    ),
    "safe_ratio": (
        "a DOUBLE, b DOUBLE", "DOUBLE", "coalesce(try_divide(a, b), 0.0D)"
    ),
    "change_type": (
        "prev DOUBLE, curr DOUBLE, delta DOUBLE", "STRING",
        "CASE WHEN prev IS NULL OR isnan(prev) OR prev = 0 THEN 'new' "
        "WHEN curr IS NULL OR isnan(curr) OR curr = 0 THEN 'disappeared' "
        f"WHEN NOT isnan(delta) AND delta > {DELTA_THRESHOLD} THEN 'intensifying' "
        f"WHEN NOT isnan(delta) AND delta < -{DELTA_THRESHOLD} THEN 'fading' ELSE 'stable' END",
    ),
    "cosine_distance": (
        "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", "DOUBLE",
        "greatest(0.0D, least(2.0D, 1.0D - coalesce(try_divide("
        "aggregate(zip_with(a, b, (x, y) -> x * y), 0.0D, (s, v) -> s + v), "
        "sqrt(aggregate(a, 0.0D, (s, v) -> s + v * v)) "
        "* sqrt(aggregate(b, 0.0D, (s, v) -> s + v * v))), 0.0D)))",
    ),
    "word_count": (
        "t STRING", "INT", r"size(filter(split(t, r'(?U)[\s\x1c-\x1f]+'), w -> w <> ''))"
    ),
    "pad_cik": (
        "k STRING", "STRING",
        "lpad(ltrim('0', trim(k)), greatest(10, length(ltrim('0', trim(k)))), '0')",
    ),
    "chunk_id": (
        "cik STRING, fiscal_year INT, section STRING, i INT", "STRING",
        "format_string('%s_%d_%s_%04d', cik, fiscal_year, section, i)",
    ),
}


@udtf(returnType="full_text string, is_ixbrl boolean")
class HtmlText:
    """``SELECT * FROM html_text(html)``: text of a document and its inline XBRL flag."""

    def eval(self, html: str) -> Iterator[tuple]:
        from tidemark.operators.sections import html_to_text

        if html is not None:
            yield html_to_text(html)


def register_functions(spark: SparkSession) -> list[str]:
    """Register every SQL function for this session; returns the names."""
    from tidemark.session import ship_package

    for name, (parameters, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} "
            f"RETURN {body}"
        )
    ship_package(spark)
    spark.udtf.register("html_text", HtmlText)
    return [*SQL_FUNCTIONS, "html_text"]
