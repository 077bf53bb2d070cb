"""Field extraction from store documents: identifiers, prices, availability, embedded JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = r"^([A-Z0-9]{5,6})[A-Z]{1,3}/[A-Z]$"


def mpn_root(mpn: Column) -> Column:
    """A part number without colour and region letters; others as they are."""
    return F.when(mpn.rlike(ROOT), F.regexp_extract(mpn, ROOT, 1)).otherwise(mpn)


def mpn_from_sku(sku: Column) -> Column:
    return F.nullif(sku, F.lit(""))


def mpn_from_lists(part_numbers: Column, barcodes: Column, article: Column) -> Column:
    """The first part number that is not the article's, else the first barcode."""
    parts = lambda x: F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), ";"), lambda p: F.trim(p)), lambda p: p != "")
    own = F.filter(parts(part_numbers), lambda p: ~p.eqNullSafe(article))
    return F.coalesce(F.get(own, F.lit(0)), F.get(parts(barcodes), F.lit(0)))


def mpn_in_brackets(title: Column) -> Column:
    """The last bracketed code that has both letters and others than letters."""
    found = F.regexp_extract_all(title, F.lit(r"\(([A-Z0-9][A-Z0-9\-/]{4,})\)"), F.lit(1))
    good = F.filter(found, lambda c: ~c.rlike("^[0-9]+$") & ~c.rlike("^[A-Z]+$"))
    return F.try_element_at(good, F.lit(-1))


def mpn_from_title(title: Column) -> Column:
    """The bracketed code, else a second word that looks like one."""
    second = F.get(F.split(F.trim(title), r"(?U)\s+"), F.lit(1))
    code = second.rlike(r"^[A-Z0-9][A-Z0-9\-/]{4,}$") & second.rlike("[0-9]") & second.rlike("[A-Z]")
    return F.coalesce(mpn_in_brackets(title), F.when(code, second))


_LD = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"


def json_ld(html: Column, kind: str = "Product") -> Column:
    """The first ld+json object, or member of an @graph, whose @type is or holds ``kind``; as text."""
    blocks = F.regexp_extract_all(html, F.lit(_LD), F.lit(1))
    graph = "array<string>"
    items = F.flatten(F.transform(blocks, lambda b: F.coalesce(F.from_json(F.get_json_object(b, "$['@graph']"), graph), F.array(F.trim(b)))))
    typed = lambda x: F.concat(F.lit(","), F.regexp_replace(F.coalesce(F.get_json_object(x, "$['@type']"), F.lit("")), r'[\[\]" ]', ""), F.lit(","))
    return F.get(F.filter(items, lambda x: F.contains(typed(x), F.lit(f",{kind},"))), F.lit(0))


def embedded_json(html: Column, marker: str) -> Column:
    """The JSON object after ``marker``: braces are balanced outside of strings."""

    @F.pandas_udf(T.StringType())
    def cut(bodies):
        import json

        def one(body):
            at = -1 if body is None else body.find(marker)
            at = body.find("{", at) if at >= 0 else -1
            if at < 0:
                return None
            try:
                return body[at : json.JSONDecoder().raw_decode(body, at)[1]]
            except ValueError:
                return None

        return bodies.map(one)

    # only pages with the marker are sent to Python
    return cut(F.when(F.contains(html, F.lit(marker)), html))


def unescape(text: Column) -> Column:
    """HTML entities as characters."""

    @F.pandas_udf(T.StringType())
    def run(values):
        import html

        return values.map(lambda v: None if v is None else html.unescape(v))

    # only texts with an entity are sent to Python
    return F.coalesce(run(F.when(F.contains(text, F.lit("&")), text)), text)


def unescape_basic(text: Column) -> Column:
    for entity, c in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(c))
    return text


def breadcrumbs(html: Column) -> Column:
    """Texts of links inside the navigation, entities resolved."""
    links = F.regexp_extract_all(html, F.lit(r'(?is)<a[^>]*href="[^"]*"[^>]*>([^<]*)</a>'), F.lit(1))
    return F.filter(F.transform(links, lambda x: F.trim(unescape_basic(x))), lambda x: x != "")


def deepest(crumbs: Column) -> Column:
    return F.try_element_at(crumbs, F.lit(-1))


def second_to_last(crumbs: Column) -> Column:
    return F.try_element_at(crumbs, F.lit(-2))


def path_tail(path: Column) -> Column:
    return F.nullif(F.trim(F.element_at(F.split(path, ">"), -1)), F.lit(""))


def og_image(html: Column, base: str) -> Column:
    """The og:image, attributes in either order; relative addresses get ``base``."""
    a = F.regexp_extract(html, r'(?is)<meta[^>]*property="og:image"[^>]*content="([^"]+)"', 1)
    b = F.regexp_extract(html, r'(?is)<meta[^>]*content="([^"]+)"[^>]*property="og:image"', 1)
    url = F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))
    return F.when(url.startswith("/"), F.concat(F.lit(base), url)).otherwise(url)


def page_title(html: Column) -> Column:
    return F.trim(unescape_basic(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))


def without_suffix(title: Column, shop: str) -> Column:
    return F.trim(F.regexp_replace(title, rf"(?i)\s*-\s*\Q{shop}\E\s*$", ""))


def upper_first_word(title: Column) -> Column:
    """The first word, if it is two or more capitals."""
    word = F.get(F.split(F.trim(title), r"(?U)\s+"), F.lit(0))
    return F.when(word.rlike(r"(?U)^\p{Lu}{2,}$"), word)


def first_word(title: Column) -> Column:
    return F.nullif(F.get(F.split(F.trim(title), r"(?U)\s+"), F.lit(0)), F.lit(""))


def attribute(attributes: Column, identifier: str) -> Column:
    """The first value of the first attribute of that name."""
    one = F.get(F.filter(attributes, lambda a: a["identifier"] == identifier), F.lit(0))
    return F.get(one["values"], F.lit(0))["value"]


def labelled_value(values: Column, labels: Column, wanted: tuple[str, ...]) -> Column:
    """The first non-blank value of values(id, value) whose label is wanted."""
    names = F.map_from_entries(labels)
    good = lambda v: F.lower(F.trim(F.try_element_at(names, v["id"]))).isin(*wanted) & (F.trim(v["value"]) != "")
    return F.trim(F.get(F.filter(values, good), F.lit(0))["value"])


def positive(price: Column) -> Column:
    return F.when(price > 0, price)


def select_price(offers: list[tuple[str, Column]]) -> Column:
    """The first positive price with the name of its source; ``none`` if there is none."""
    out = F.struct(F.lit(None).cast("decimal(18,4)").alias("price"), F.lit("none").alias("source"))
    for name, raw in reversed(offers):
        value = raw.try_cast("decimal(18,4)")
        out = F.when(value > 0, F.struct(value.alias("price"), F.lit(name).alias("source"))).otherwise(out)
    return out


def orderable(buyable: Column, flag: Column) -> Column:
    return F.coalesce((F.lower(buyable) == "true") & (F.coalesce(flag, F.lit("")) != "false"), F.lit(False))


def available_text(text: Column, count: Column, phrases: tuple[str, ...]) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin(*phrases), F.lit(False)) | F.coalesce(count > 0, F.lit(False))


def in_stock(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit("InStock")), F.lit(False))


def ean_from_specs(specs: Column) -> Column:
    value = F.trim(F.get(F.filter(specs, lambda s: F.lower(s["name"]) == "ean"), F.lit(0))["value"])
    return F.when(value.rlike("^[0-9]{8,14}$"), value)


def variant_title(product: Column, variant: Column) -> Column:
    plain = F.coalesce(variant, F.lit("")).isin("", "Default Title")
    return F.when(plain, product).otherwise(F.concat(product, F.lit(" – "), variant))


# Statuses that can be ordered.
STATUS_AVAILABLE = ("IMMEDIATELY_AVAILABLE", "LAST_PIECES", "ON_ORDER")


def status_available(status: Column) -> Column:
    return F.coalesce(status.isin(*STATUS_AVAILABLE), F.lit(False))


def product_url(base: str, path: Column, part: Column) -> Column:
    """The address of a relative path, else that of the part number."""
    return F.concat(F.lit(base + "/"), F.coalesce(F.nullif(path, F.lit("")), F.concat(F.lit("product/"), part)))


def image_or(url: Column, prefix: str, part: Column, suffix: str) -> Column:
    """The image address, else one made of the part number."""
    return F.coalesce(F.nullif(url, F.lit("")), F.concat(F.lit(prefix), part, F.lit(suffix)))


def retry_after(value: Column, now: Column) -> Column:
    """Seconds to wait by a Retry-After value: seconds or an HTTP date; null if unreadable or past."""
    seconds = F.trim(value).try_cast("double")
    day = F.concat(F.regexp_replace(F.trim(value), "^[A-Za-z]{3}, | GMT$", ""), F.lit(" +0000"))
    until = F.try_to_timestamp(day, F.lit("d MMM yyyy HH:mm:ss xx"))
    wait = F.coalesce(seconds, (F.unix_micros(until) - F.unix_micros(now)) / 1e6)
    return F.when(~F.isnan(wait) & (wait > 0), wait)


def id_after_products(url: Column) -> Column:
    """The digits at the end after /products/, else the last part of the path."""
    return F.coalesce(F.nullif(F.regexp_extract(url, r"/products/([0-9]+)$", 1), F.lit("")), F.element_at(F.split(url, "/"), -1))


def numeric_id(url: Column) -> Column:
    """The last part of the address if it is a number; trailing slashes do not count."""
    last = F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)
    return F.when(last.rlike("^[0-9]+$"), last)


def top_category(url: Column, base: str) -> Column:
    """The second part of the path below ``base``, null if there is none."""
    return F.get(F.split(F.regexp_replace(F.replace(url, F.lit(base), F.lit("")), "^/+|/+$", ""), "/"), F.lit(1))
