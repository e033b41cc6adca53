"""What a page's HTML holds: head, JSON-LD, images and tables.

Head fields and JSON-LD are column expressions.  Images and tables need a parser:
one pass over the HTML in Arrow batches gives both.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigrade.functions import vocab
from evigrade.functions.text import filled

MOST_TABLES = 40
_IMAGE_TAGS = {"img", "source", "a", "link", "meta", "video", "div", "span"}
_CSS_URL = re.compile(r"url\((['\"]?)(.*?)\1\)", re.I)
_IMAGE_FILE = re.compile(r"\.(?:jpe?g|png|webp|gif)(?:[?#]|$)", re.I)


def head_meta(html: Column | str) -> dict[str, Column]:
    """title, canonical_url, description, og and product_meta."""
    html = filled(html)
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)

    def pairs(prefix: str) -> Column:
        pattern = rf"(?is)<meta[^>]+(?:property|name)=[\"']({prefix}:[^\"']+)[\"'][^>]+content=[\"']([^\"']*)[\"']"
        keys = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
        values = F.regexp_extract_all(html, F.lit(pattern), F.lit(2))
        return F.map_from_entries(F.arrays_zip(keys.alias("k"), values.alias("v")))

    return {
        "title": F.trim(F.regexp_replace(title, r"\s+", " ")),
        "canonical_url": F.regexp_extract(html, r"(?is)<link[^>]+rel=[\"']canonical[\"'][^>]+href=[\"']([^\"']+)[\"']", 1),
        "description": F.regexp_extract(
            html, r"(?is)<meta[^>]+(?:name|property)=[\"'](?:og:)?description[\"'][^>]+content=[\"']([^\"']*)[\"']", 1
        ),
        "og": pairs("og"),
        "product_meta": pairs("product"),
    }


def _json_ld_items(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, script, pos, value): every product or offer of a page's JSON-LD as a variant."""
    scripts = F.regexp_extract_all(
        filled(html), F.lit(r"(?is)<script[^>]+type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"), F.lit(1)
    )
    blocks = pages.select(key, F.posexplode(scripts).alias("script", "json"))
    blocks = blocks.withColumn("json", F.trim("json"))
    graph = F.get_json_object("json", "$.@graph")
    whole = F.when(F.col("json").startswith("["), F.col("json")).otherwise(
        F.coalesce(graph, F.concat(F.lit("["), F.col("json"), F.lit("]")))
    )
    listed = blocks.withColumn("v", F.try_parse_json(whole)).where("v is not null")
    items = listed.lateralJoin(
        listed.sparkSession.tvf.variant_explode_outer(F.col("v").outer())
    ).select(key, "script", F.col("pos"), F.col("value"))
    kind = F.lower(F.coalesce(F.try_variant_get("value", "$['@type']", "string"), F.lit("")))
    return items.where(kind.contains("product") | kind.contains("offer"))


def json_ld_products(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """One row for each product or offer in a page's JSON-LD.

    Scripts may hold an object, an array or an @graph; types may be arrays; brand may
    be an object; bad JSON gives nothing.  Columns: key, position, type, name, brand,
    sku, mpn, gtin, description and price, currency, availability of the first offer.
    """
    items = _json_ld_items(pages, key, html)

    def text(path: str) -> Column:
        return F.try_variant_get("value", path, "string")

    kind = F.lower(F.coalesce(text("$['@type']"), F.lit("")))
    offer = F.coalesce(F.try_variant_get("value", "$.offers[0]", "variant"), F.try_variant_get("value", "$.offers", "variant"))
    brand = F.coalesce(text("$.brand.name"), F.when(~F.coalesce(text("$.brand"), F.lit("")).startswith("{"), text("$.brand")))
    gtins = [text(f"$.{g}") for g in ("gtin", "gtin13", "gtin14", "gtin12", "gtin8", "ean")]
    found = items.withColumn("o", offer)
    return found.select(
        key,
        (F.col("script") * 1000 + F.coalesce("pos", F.lit(0))).alias("position"),
        kind.alias("type"),
        F.coalesce(text("$.name"), F.lit("")).alias("name"),
        F.coalesce(brand, F.lit("")).alias("brand"),
        F.coalesce(text("$.sku"), F.lit("")).alias("sku"),
        F.coalesce(text("$.mpn"), F.lit("")).alias("mpn"),
        F.coalesce(*gtins, F.lit("")).alias("gtin"),
        F.left(F.coalesce(text("$.description"), F.lit("")), F.lit(700)).alias("description"),
        F.coalesce(F.try_variant_get("o", "$.price", "string"), F.lit("")).alias("price"),
        F.coalesce(F.try_variant_get("o", "$.priceCurrency", "string"), F.lit("")).alias("currency"),
        F.right(F.coalesce(F.try_variant_get("o", "$.availability", "string"), F.lit("")), F.lit(80)).alias("availability"),
    )


#: Absolute image links anywhere in a page.  A fixed value.
IMAGE_LINK = r"(?i)https?://[^\s'\")<>]+?\.(?:jpg|jpeg|png|webp|gif)(?:\?[^\s'\")<>]*)?"


def linked_images(html: Column | str) -> Column:
    """Distinct absolute image links of a page, in order, wherever they stand."""
    return F.array_distinct(F.regexp_extract_all(filled(html), F.lit(IMAGE_LINK), F.lit(0)))


def all_images(pages: DataFrame, key: str, url: str = "url", html: str = "html") -> DataFrame:
    """(key, images): the parser's candidates, then links in the text, then og:image values; the first alt text of a URL stays.

    og:image values count if they are absolute.
    """
    meta = head_meta(html)["og"]
    heroes = F.transform(
        F.filter(F.map_entries(meta), lambda e: F.lower(e["key"]).endswith("image") & e["value"].rlike("(?i)^https?://")),
        lambda e: F.struct(e["value"].alias("url"), F.lit("og:image").alias("alt")),
    )
    found = F.transform(linked_images(html), lambda u: F.struct(u.alias("url"), F.lit("regex/image-url").alias("alt")))
    more = pages.withColumn("_more", F.concat(found, heroes))
    whole = extract_pages(more, key, url, html, ("_more",)).select(key, F.concat("images", "_more").alias("_all"))

    def add(seen: Column, one: Column) -> Column:
        known = F.exists(seen, lambda i: i["url"] == one["url"])
        return F.when(known, seen).otherwise(F.concat(seen, F.array(one)))

    none = F.array().cast("array<struct<url:string,alt:string>>")
    return whole.select(key, F.aggregate("_all", none, add).alias("images"))


def compact_offers(offers: Column) -> Column:
    """Offers given as a variant, an object or an array, as an array of five fields; anything else gives none."""
    one = F.try_variant_get(offers, "$", "struct<price:string,priceCurrency:string,availability:string,sku:string,url:string>")
    many = F.try_variant_get(offers, "$", "array<struct<price:string,priceCurrency:string,availability:string,sku:string,url:string>>")
    kind = F.schema_of_variant(offers)
    given = F.when(kind.startswith("ARRAY"), many).when(kind.startswith("OBJECT"), F.array(one))
    made = F.transform(
        F.filter(given, lambda o: o.isNotNull()),
        lambda o: F.struct(
            filled(o["price"]).alias("price"),
            filled(o["priceCurrency"]).alias("priceCurrency"),
            F.right(filled(o["availability"]), F.lit(80)).alias("availability"),
            filled(o["sku"]).alias("sku"),
            filled(o["url"]).alias("url"),
        ),
    )
    return F.coalesce(made, F.array().cast("array<struct<price:string,priceCurrency:string,availability:string,sku:string,url:string>>"))


def json_ld_offers(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, position, name, offers): all offers of each product in a page's JSON-LD."""
    found = _json_ld_items(pages, key, html)
    offers = compact_offers(F.try_variant_get("value", "$.offers", "variant"))
    name = filled(F.try_variant_get("value", "$.name", "string"))
    position = (F.col("script") * 1000 + F.coalesce("pos", F.lit(0))).alias("position")
    return found.select(key, position, name.alias("name"), offers.alias("offers"))


def overlay_metadata(metadata: Column, html: Column | str) -> dict[str, Column]:
    """Head fields of a page: a crawler's metadata map first, the HTML for what it lacks; HTML entries of og and product win."""
    head = head_meta(html)
    given = F.map_from_entries(F.transform(F.map_entries(metadata), lambda e: F.struct(F.lower(e["key"]), e["value"])))
    of = lambda prefix: F.map_filter(F.coalesce(given, F.from_json(F.lit("{}"), "map<string,string>")), lambda k, v: k.startswith(prefix) & v.isNotNull())
    said = lambda name: F.nullif(filled(F.try_element_at(metadata, F.lit(name))), F.lit(""))
    lower = lambda m: F.map_from_entries(F.transform(F.map_entries(m), lambda e: F.struct(F.lower(e["key"]), e["value"])))
    return {
        "title": F.coalesce(said("title"), head["title"]),
        "description": F.coalesce(said("description"), head["description"]),
        "canonical_url": head["canonical_url"],
        "og": F.map_concat(of("og:"), lower(head["og"])),
        "product_meta": F.map_concat(of("product:"), lower(head["product_meta"])),
    }


class PageParser(HTMLParser):
    """Image candidates with alt texts, and outermost tables, in document order."""

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.alt = base, ""
        self.images: dict[str, str] = {}
        self.tables: list[dict] = []
        self.depth = 0
        self.cell: list[str] | None = None
        self.caption: list[str] | None = None

    def _candidate(self, link: str, alt: str, certain: bool) -> None:
        link = link.strip()
        if not link or link.startswith("data:"):
            return
        whole = urljoin(self.base, link)
        if whole.lower().startswith(("http://", "https://")) and (certain or _IMAGE_FILE.search(whole)):
            self.images.setdefault(whole, alt)

    def handle_starttag(self, tag, attrs):
        given = {k: v or "" for k, v in attrs}
        if tag in _IMAGE_TAGS:
            self.alt = given.get("alt") or given.get("title") or self.alt
            for name in vocab.IMAGE_ATTRIBUTES:
                value = given.get(name, "")
                if not value:
                    continue
                links = [p.split()[0] for p in value.split(",") if p.split()] if "srcset" in name else [value]
                for link in links:
                    self._candidate(link, self.alt, certain=tag in ("img", "source") and name not in ("content", "href"))
            for _, link in _CSS_URL.findall(given.get("style", "")):
                self._candidate(link, self.alt, certain=False)
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.tables.append({"rows": [], "caption": ""})
        elif self.depth == 1:
            if tag == "tr":
                self.tables[-1]["rows"].append([])
            elif tag in ("td", "th"):
                self.cell = []
            elif tag == "caption":
                self.caption = []

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th") and self.cell is not None:
            rows = self.tables[-1]["rows"]
            if not rows:
                rows.append([])
            rows[-1].append(" ".join("".join(self.cell).split()).replace("|", "\\|"))
            self.cell = None
        elif self.depth == 1 and tag == "caption" and self.caption is not None:
            self.tables[-1]["caption"] = " ".join("".join(self.caption).split())
            self.caption = None

    def handle_data(self, data):
        if self.caption is not None:
            self.caption.append(data)
        elif self.cell is not None:
            self.cell.append(data)


def table_markdown(rows: list[list[str]]) -> tuple[str, int, int]:
    """Markdown with the first row as header, ragged rows filled; and its rows and columns."""
    rows = [r for r in rows if r]
    width = max(map(len, rows), default=0)
    if not width:
        return "", 0, 0
    lines = ["| " + " | ".join([*r, *[""] * (width - len(r))]) + " |" for r in rows]
    lines.insert(1, "|" + " --- |" * width)
    return "\n".join(lines), len(rows), width


def extract_page(html: str, base: str) -> tuple[list[dict], list[dict]]:
    parser = PageParser(base)
    parser.feed(html)
    parser.close()
    tables = []
    for index, table in enumerate(parser.tables[:MOST_TABLES], 1):
        markdown, rows, columns = table_markdown(table["rows"])
        if markdown:
            tables.append({"index": index, "caption": table["caption"], "n_rows": rows, "n_columns": columns, "markdown": markdown})
    return [{"url": u, "alt": a} for u, a in parser.images.items()], tables


_IMAGES = pa.list_(pa.struct([("url", pa.string()), ("alt", pa.string())]))
_TABLES = pa.list_(
    pa.struct(
        [("index", pa.int32()), ("caption", pa.string()), ("n_rows", pa.int32()), ("n_columns", pa.int32()), ("markdown", pa.string())]
    )
)


def extract_pages(pages: DataFrame, key: str, url: str = "url", html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, images, tables) of every page, from one parse, and the columns to keep, which pass the parser with their page."""
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extract_page(h or "", u or "") for u, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            images, tables = pa.array([f[0] for f in found], _IMAGES), pa.array([f[1] for f in found], _TABLES)
            yield pa.RecordBatch.from_arrays([batch.column(0), images, tables, *batch.columns[3:]], names=[key, "images", "tables", *keep])

    schema = (
        f"`{key}` {kinds[key]}, images array<struct<url:string,alt:string>>, tables array<struct<index:int,caption:string,"
        "n_rows:int,n_columns:int,markdown:string>>"
    )
    schema += "".join(f", `{c}` {kinds[c]}" for c in keep)
    return pages.select(key, url, html, *keep).mapInArrow(run, schema)
