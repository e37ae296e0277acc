"""Listings and records inside HTML and JSON text, as expressions over a text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where pages carry their data.
NEXT_DATA = r'(?is)<script[^>]*\bid="__NEXT_DATA__"[^>]*>(.*?)</script>'
LISTING_PATH = "$.props.pageProps.listing"
DETAIL_LABELS = {"property_type": "property type", "area_sqm": "area", "city": "city", "district": "district"}
ITEMS_PER_PAGE = 50


def _strip(text: Column) -> Column:
    """Text content: tags removed, basic entities decoded, ends trimmed; empty is NULL."""
    plain = F.regexp_replace(text, r"(?s)<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.regexp_replace(plain, r"^\s+|\s+$", "")


def _first(html: Column, pattern: str, group: int = 1) -> Column:
    """First match of `pattern`, NULL when there is none."""
    return F.when(F.regexp_like(html, F.lit(pattern)), F.regexp_extract(html, pattern, group))


def html_embedded_json(pages: DataFrame, html: str = "html", path: str = LISTING_PATH) -> DataFrame:
    """The listing object inside each page's embedded JSON; pages without one are dropped."""
    listing = F.get_json_object(F.regexp_extract(F.col(html), NEXT_DATA, 1), path)
    return pages.withColumn("listing", listing).where(F.col("listing").isNotNull()).drop(html)


def html_listing_fields(pages: DataFrame, html: str = "html", source: str = "listing-pages") -> DataFrame:
    """Title, price, labelled details, description and coordinates of listing pages."""
    h = F.col(html)
    block = lambda cls: rf'(?is)<div[^>]*\bclass="[^"]*\b{cls}\b[^"]*"[^>]*>(.*?)</div>'
    row = r'(?is)<li[^>]*>.*?<span[^>]*\bclass="label"[^>]*>(.*?)</span>.*?<span[^>]*\bclass="value"[^>]*>(.*?)</span>.*?</li>'
    box = _first(h, r'(?is)<ul[^>]*\bclass="[^"]*\bproperty-params\b[^"]*"[^>]*>(.*?)</ul>')
    labels = F.regexp_extract_all(box, F.lit(row), F.lit(1))
    values = F.regexp_extract_all(box, F.lit(row), F.lit(2))
    pairs = F.zip_with(labels, values, lambda k, v: F.struct(F.lower(_strip(k)).alias("k"), _strip(v).alias("v")))
    detail = lambda name: F.get(F.filter(F.col("_pairs"), lambda p: p["k"] == name), F.lit(0))["v"]
    located = r'(?is)<div[^>]*\bdata-lat="[^"]*"[^>]*\bdata-lng="[^"]*"[^>]*>'
    tag = _first(h, rf"({located})")
    return pages.withColumn("_pairs", pairs).select(
        *[c for c in pages.columns if c != html],
        F.lit(source).alias("source"),
        _strip(_first(h, r"(?is)<h1[^>]*>(.*?)</h1>")).alias("title"),
        _strip(_first(h, block("price"))).alias("price"),
        *[detail(label).alias(name) for name, label in DETAIL_LABELS.items()],
        _strip(_first(h, block("description"))).alias("description"),
        F.nullif(F.regexp_extract(tag, r'data-lat="([^"]*)"', 1), F.lit("")).alias("latitude"),
        F.nullif(F.regexp_extract(tag, r'data-lng="([^"]*)"', 1), F.lit("")).alias("longitude"),
    )


def html_table_value(html: Column, label: str) -> Column:
    """Value cell that follows a label cell of a table, label matched in any case."""
    return _strip(_first(html, rf"(?is)<td[^>]*>[^<]*{label}[^<]*</td>\s*<td[^>]*>(.*?)</td>"))


def json_pages_explode(pages: DataFrame, item_schema: str, payload: str = "payload") -> DataFrame:
    """Items of paged responses, with the total and the number of pages it implies."""
    p = F.from_json(F.col(payload), f"struct<total:bigint,items:array<{item_schema}>>")
    parsed = pages.withColumn("_p", p)
    return parsed.select(
        *[c for c in pages.columns if c != payload],
        F.coalesce(F.col("_p.total"), F.lit(0)).alias("total"),
        F.ceil(F.coalesce(F.col("_p.total"), F.lit(0)) / ITEMS_PER_PAGE).alias("pages"),
        F.explode("_p.items").alias("_i"),
    ).select("*", "_i.*").drop("_i")


def ckan_resource_pick(df: DataFrame, wanted: str = "csv", payload: str = "payload") -> DataFrame:
    """URL of the first resource with the wanted format, any case; NULL when there is none."""
    p = F.from_json(F.col(payload), "struct<result:struct<resources:array<struct<format:string,url:string>>>>")
    hit = F.get(F.filter(p["result"]["resources"], lambda r: F.lower(r["format"]) == wanted), F.lit(0))
    return df.withColumn("csv_url", hit["url"]).drop(payload)


def json_array_to_rows(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ("district_id", "district_name")) -> DataFrame:
    """One row per element of a JSON array, each element kept as JSON text."""
    elements = F.from_json(F.col(payload), "array<variant>")
    return df.select(*keep, F.posexplode(elements).alias("pos", "_e")).select(
        *keep, "pos", F.to_json("_e").alias("payload")
    )
