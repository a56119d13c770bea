"""HTML asset inlining as expressions and one Arrow UDF."""

from __future__ import annotations

import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCRIPT = r"(?i)<script\b[^>]*\bsrc\s*=\s*[\"']([^\"']+)[\"'][^>]*>\s*</script>"
STYLESHEET = r"(?i)<link\b(?=[^>]*\brel\s*=\s*[\"']stylesheet[\"'])[^>]*\bhref\s*=\s*[\"']([^\"']+)[\"'][^>]*>"
CSS_URL = re.compile(r"url\(\s*(['\"]?)([^'\")]+)\1\s*\)")


def script_urls(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(SCRIPT), 1)


def stylesheet_urls(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(STYLESHEET), 1)


def external(urls: Column) -> Column:
    """Those that a browser would fetch."""
    return F.filter(urls, lambda u: u.rlike("(?i)^(https?:)?//"))


def remaining(html: Column) -> Column:
    """External scripts and stylesheets a page still has."""
    return external(F.concat(script_urls(html), stylesheet_urls(html)))


def declare_language(html: Column, lang: str = "pt-BR") -> Column:
    """Lang on the html element, unless it has one."""
    has = html.rlike(r"(?i)<html\b[^>]*\blang\s*=")
    at = F.regexp_instr(html, F.lit(r"(?i)<html\b"))
    return F.when(has | (at == 0), html).otherwise(F.concat(F.substring(html, F.lit(1), at + 4), F.lit(f' lang="{lang}"'), F.substring(html, at + 5, F.length(html))))


def absolute_css(css: str, base: str) -> str:
    """url() references against their stylesheet; absolute ones, data and fragments stay."""

    def one(m: re.Match) -> str:
        url = m[2].strip()
        if re.match(r"(?i)([a-z][a-z0-9+.-]*:|//|#)", url):
            return m[0]
        return f"url({m[1]}{urljoin(base, url)}{m[1]})"

    return CSS_URL.sub(one, css)


@F.pandas_udf(T.StringType())
def absolute_css_urls(css: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([None if c is None else absolute_css(c, b or "") for c, b in zip(css, base, strict=True)])


def inline(pages: DataFrame, resources: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """External scripts and stylesheets of pages replaced by their contents.

    resources: url, body (CSS with absolute references already). Adds scripts and stylesheets, the
    numbers replaced. A tag whose resource is missing stays. Pages meet resources by a join on the
    address; the parts of a page are put together again by position.
    """
    tag = f"(?:{SCRIPT})|(?:{STYLESHEET})"
    between = F.split(F.col(html), tag, -1)
    tags = F.regexp_extract_all(F.col(html), F.lit(tag), 0)
    parts = pages.select(key, F.posexplode_outer(F.arrays_zip(between.alias("text"), tags.alias("tag"))).alias("pos", "p")).select(key, "pos", "p.text", "p.tag")
    url = F.coalesce(F.nullif(F.regexp_extract("tag", SCRIPT, 1), F.lit("")), F.nullif(F.regexp_extract("tag", STYLESHEET, 1), F.lit("")))
    met = parts.withColumn("url", url).join(resources.select("url", "body"), "url", "left")
    script = F.col("tag").rlike("(?i)^<script")
    body = F.when(script, F.concat(F.lit("<script>"), F.regexp_replace("body", "(?i)</(script)", r"<\\/$1"), F.lit("</script>"))).otherwise(F.concat(F.lit("<style>"), F.regexp_replace("body", "(?i)</(style)", r"<\\/$1"), F.lit("</style>")))
    done = F.col("body").isNotNull()
    met = met.withColumn("out", F.concat(F.coalesce("text", F.lit("")), F.when(done, body).otherwise(F.coalesce("tag", F.lit("")))))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "out"))), lambda x: x["out"]), "")  # the parts of one page
    return met.groupBy(key).agg(joined.alias(html), F.count_if(done & script).alias("scripts"), F.count_if(done & ~script).alias("stylesheets"))
