"""Listing pages as rows: result cards, detail pages, carousels, and the route a page takes.

A page is read once, in Arrow batches, by the standard library's HTML parser; SELECTORS name what is
taken from it. JSON texts and plain texts come out, and everything else is built-in functions on them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exprs as X

#: Part of a page: (part it lies in, selectors). Selectors know tag, #id, .class, [attr], [attr=x], [attr^=x], [attr*=x], descendants and commas.
SELECTORS = {
    "title": (None, "title"), "link": (None, "a[href]"), "card": (None, "fuse-card[data-vehicle-details], spark-card[data-vehicle-details]"),
    "notice": (None, "spark-notification.unlisted-notification"), "data": (None, "script#initial-activity-data"),
    "dealer": (None, ".dealer-card"), "dealer_name": ("dealer", "h3, h4"), "dealer_address": ("dealer", ".map-link a"), "dealer_website": ("dealer", ".website a"), "dealer_link": ("dealer", "a[href*=/dealers/]"), "dealer_rating": ("dealer", "fuse-rating"),
    "carousel": (None, "div.listings-carousel"), "item": ("carousel", "fuse-card, spark-card"), "item_save": ("item", "fuse-save[data-listing-id], spark-save[data-listing-id]"), "item_link": ("item", "a[href^=/vehicledetail/]"), "item_price": ("item", "span.price"), "item_body": ("item", "span.body"), "item_footer": ("item", "span[slot=footer]"),
}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: JSON path and kind of a result card's fields.
CARD_FIELDS = {
    "vin": ("$.vin", "string"), "make": ("$.make", "string"), "model": ("$.model", "string"), "trim": ("$.trim", "string"), "year": ("$.year", "int"), "price": ("$.price", "int"), "msrp": ("$.msrp", "int"), "mileage": ("$.mileage", "int"),
    "stock_type": ("$.stockType", "string"), "fuel_type": ("$.fuelType", "string"), "body_style": ("$.bodyStyle", "string"), "financing_type": ("$.financingType", "string"), "seller_zip": ("$.seller.zip", "string"), "seller_customer_id": ("$.seller.customerId", "string"),
    "trid": ("$.trid", "string"), "page_number": ("$.metadata.page_number", "int"), "position_on_page": ("$.metadata.position_on_page", "int"), "last_seen_price": ("$.price", "int"),
}
DETAIL_FIELDS = {
    "vin": ("$.vin", "string"), "make": ("$.make", "string"), "model": ("$.model", "string"), "trim": ("$.trim", "string"), "year": ("$.year", "int"), "price": ("$.price", "int"), "mileage": ("$.mileage", "int"), "msrp": ("$.msrp", "int"),
    "stock_type": ("$.stock_type", "string"), "fuel_type": ("$.fuel_type", "string"), "body_style": ("$.bodystyle", "string"), "seller_id": ("$.seller_id", "string"), "customer_id": ("$.customer_id", "string"),
}
# The patterns that decide a page's state and take texts apart.
CHALLENGE = r"(?i)just a moment|attention required|checking your browser"
UNLISTED = r"(?i)\bno longer available\b|\bno longer listed\b"
MARKER = "page contains 'no longer available/listed' marker text"
ADDRESS = r"(\d+[^,]+),\s*([^,]+),\s*([A-Z]{2})\s*(\d{5})"
UUID = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
SELLER = re.compile(r'"seller"\s*:\s*(\{[^}]+\})')
BODY = r"(?i)^(New|Used|Certified|CPO)\s+(\d{4})\s+(.*)$"


@dataclass
class Element:
    """An open or closed element; parts: what it is of SELECTORS."""

    tag: str
    attrs: dict[str, str | None]
    parts: dict[str, int] = field(default_factory=dict)


@dataclass
class Found:
    """A part found: the number of the part it lies in, its attributes and its texts."""

    inside: int | None
    attrs: dict[str, str | None]
    texts: list[str] = field(default_factory=list)

    def text(self, between: str = " ") -> str | None:
        return between.join(t for x in self.texts if (t := x.strip())) or None


def compound(text: str):
    """A test of one element: tag, #id, .class and attributes. Its own `tag` is the one it asks for, empty for any."""
    tag = re.match(r"[\w-]*", text)[0]
    need_id = re.findall(r"#([\w-]+)", text.split("[")[0])
    classes = set(re.findall(r"\.([\w-]+)", text.split("[")[0]))
    attrs = re.findall(r"\[([\w-]+)(?:([*^]?=)([^\]]*))?\]", text)

    def test(e: Element) -> bool:
        if tag and e.tag != tag or need_id and e.attrs.get("id") not in need_id:
            return False
        if classes and not (e.attrs.get("class") and classes <= set(e.attrs["class"].split())):
            return False
        for name, how, value in attrs:
            own = e.attrs.get(name)
            if name not in e.attrs or how and (own is None or not {"=": own == value, "^=": own.startswith(value), "*=": value in own}[how]):
                return False
        return True

    test.tag = tag
    return test


def selector(text: str) -> list[list]:
    """Alternatives, each the tests from an outer to the innermost element."""
    return [[compound(x) for x in alternative.split()] for alternative in text.split(",")]


RULES = {name: (inside, selector(text)) for name, (inside, text) in SELECTORS.items()}


@lru_cache(4096)
def rules_of(tag: str) -> list[tuple]:
    """(part, part it lies in, alternatives) of RULES, without what asks for another tag."""
    fit = {name: [a for a in alternatives if a[-1].tag in ("", tag)] for name, (_, alternatives) in RULES.items()}
    return [(name, RULES[name][0], some) for name, some in fit.items() if some]


class Reader(HTMLParser):
    """One pass over a page: every part that SELECTORS name, in order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[Element] = []
        self.found: dict[str, list[Found]] = {name: [] for name in RULES}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        e = Element(tag, dict(reversed(attrs)))  # of repeated attributes the first counts
        for name, inside, alternatives in rules_of(tag):
            if not any(self.fits(a, e) for a in alternatives):
                continue
            depth = next((k for k in range(len(self.open) - 1, -1, -1) if inside in self.open[k].parts), None) if inside else -1
            if depth is not None:
                e.parts[name] = len(self.found[name])
                self.found[name].append(Found(self.open[depth].parts[inside] if inside else None, e.attrs))
        if tag not in VOID:
            self.open.append(e)

    def updatepos(self, i: int, j: int) -> int:
        return j  # nobody asks for line numbers

    def fits(self, tests: list, e: Element) -> bool:
        """Do the outer tests fit elements around e, in their order?"""
        if not tests[-1](e):
            return False
        if len(tests) == 1:
            return True
        rest = tests[:-1]
        for around in reversed(self.open):
            if rest and rest[-1](around):
                rest = rest[:-1]
        return not rest

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        for e in self.open:
            for name, number in e.parts.items():
                self.found[name][number].texts.append(data)

    def first(self, name: str, inside: int | None = None) -> Found | None:
        return next((x for x in self.found[name] if inside is None or x.inside == inside), None)

    def text(self, name: str, inside: int | None = None, between: str = " ") -> str | None:
        x = self.first(name, inside)
        return x.text(between) if x else None

    def attr(self, name: str, attr: str, inside: int | None = None) -> str | None:
        x = self.first(name, inside)
        return x.attrs.get(attr) if x else None


#: A script or a style sheet, whose texts have no references; or a & that no whole reference follows.
BARE = re.compile(r"(<(script|style)\b.*?</\2\s*>)|&(?!(?:[a-z][a-z0-9]*|#[0-9]+|#x[0-9a-f]+);)", re.I | re.S)


def read(page: str | None, bare: bool = True) -> Reader:
    """bare: character references without their semicolon (&amp) count, as in browsers."""
    r = Reader()
    r.feed((page or "") if bare else BARE.sub(lambda m: m[1] or "&amp;", page or ""))
    r.close()
    return r


TEXTS = lambda *names: pa.struct([(n, pa.string()) for n in names])
PARSED = pa.schema([
    ("title", pa.string()), ("n_links", pa.int32()), ("marked", pa.bool_()), ("notice", TEXTS("title", "text")), ("cards", pa.list_(pa.string())), ("vehicle", pa.string()),
    ("dealer", TEXTS("name", "address", "website", "link", "rating", "seller")), ("carousel", pa.list_(TEXTS("save", "link", "price", "body", "footer"))),
])
DDL = "title string, n_links int, marked boolean, notice struct<title: string, text: string>, cards array<string>, vehicle string, dealer struct<name: string, address: string, website: string, link: string, rating: string, seller: string>, carousel array<struct<save: string, link: string, price: string, body: string, footer: string>>"


def parts(page: str | None, bare: bool = True) -> dict:
    """The fields of PARSED."""
    r = read(page, bare)
    notice, data = r.first("notice"), r.first("data")
    dealer = None
    if r.found["dealer"]:
        seller = SELLER.search(html.unescape(page))
        dealer = {"name": r.text("dealer_name", 0, ""), "address": r.text("dealer_address", 0, ""), "website": r.attr("dealer_website", "href", 0) or ("" if r.first("dealer_website", 0) else None), "link": r.attr("dealer_link", "href", 0), "rating": r.attr("dealer_rating", "rating", 0), "seller": seller[1] if seller else None}
    items = [k for k, x in enumerate(r.found["item"]) if x.inside == 0]
    return {
        "title": "".join(r.found["title"][0].texts) if r.found["title"] else None, "n_links": sum(bool(x.attrs["href"]) for x in r.found["link"]), "marked": bool(re.search(UNLISTED, page or "")),
        "notice": {"title": (notice.attrs.get("title") or "").strip() or None, "text": notice.text()} if notice else None, "cards": [x.attrs["data-vehicle-details"] or "" for x in r.found["card"]], "vehicle": "".join(data.texts).strip() or None if data else None, "dealer": dealer,
        "carousel": [{"save": (r.attr("item_save", "data-listing-id", k) or "").strip() or None, "link": r.attr("item_link", "href", k), **{c: r.text(f"item_{c}", k) for c in ("price", "body", "footer")}} for k in items] if r.found["carousel"] else None,
    }


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """rows dealt by key to as many tasks as the session shuffles to, before their pages are made.

    Reading a page takes about a millisecond, so a few MB of rows are minutes of work, and splits by size one task.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def parsed(pages: DataFrame, key: str, page: str, url: str | None = None, bare: bool = True) -> DataFrame:
    """key, url, and the parts of every page, with page_state (blocked, unlisted, active).

    A page with its vehicle's data is no challenge, whatever its title. A null page has no parts and is active.
    With bare=False, character references without a semicolon stay as they are.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.RecordBatch.from_pylist([parts(x, bare) for x in batch.column(2).to_pylist()], schema=PARSED)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *rows.columns], names=["k", "url", *PARSED.names])

    kind = dict(pages.dtypes)[key]
    out = pages.select(F.col(key).alias("k"), (F.col(url) if url else F.lit(None)).cast("string").alias("url"), page).mapInArrow(each, f"k {kind}, url string, {DDL}").withColumnRenamed("k", key)
    data = F.try_parse_json("vehicle")
    out = out.withColumn("vehicle", F.when(F.coalesce(F.schema_of_variant(data), F.lit("VOID")).isin("VOID", "OBJECT<>", "ARRAY<VOID>") | F.trim("vehicle").isin("0", "false", '""'), None).otherwise(F.col("vehicle")))
    blocked = F.col("vehicle").isNull() & F.coalesce(F.col("title").rlike(CHALLENGE), F.lit(False))
    return out.withColumn("page_state", F.when(blocked, "blocked").when(F.col("notice").isNotNull() | F.col("marked"), "unlisted").otherwise("active"))


def json_field(data: Column, path: str, kind: str) -> Column:
    """A field as text; as a number, numbers cut to whole ones and texts by their digits."""
    text = F.try_variant_get(data, path, "string")
    if kind == "string":
        return text
    of = F.schema_of_variant(F.try_variant_get(data, path, "variant"))
    return F.when(of == "STRING", X.digits_to_int(text)).otherwise(F.try_variant_get(data, path, "double").cast("int"))


def filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def card_rows(pages: DataFrame, key: str, site: str = "") -> DataFrame:
    """One row a result card that is a JSON object with a listing id."""
    v = F.col("v")
    rows = pages.select(key, F.explode("cards").alias("card")).select(key, F.try_parse_json("card").alias("v"))
    rows = rows.withColumn("listing_id", filled(F.trim(F.try_variant_get(v, "$.listingId", "string")))).filter("listing_id is not null")
    isa = F.when(F.schema_of_variant(F.try_variant_get(v, "$.isaContext", "variant")) == "STRING", F.upper(filled(F.try_variant_get(v, "$.isaContext", "string"))))
    return rows.select(key, "listing_id", F.concat(F.lit(f"{site}/vehicledetail/"), "listing_id", F.lit("/")).alias("canonical_detail_url"), *[json_field(v, path, kind).alias(name) for name, (path, kind) in CARD_FIELDS.items()], isa.alias("isa_context"))


def card_counts(pages: DataFrame, key: str) -> DataFrame:
    """Per page: cards found, cards with a listing id, cards that are no JSON."""
    ids = F.filter("cards", lambda c: filled(F.trim(F.try_variant_get(F.try_parse_json(c), "$.listingId", "string"))).isNotNull())
    return pages.select(key, F.size("cards").alias("cards_found"), F.size(ids).alias("listing_ids_extracted"), F.size(F.filter("cards", lambda c: F.try_parse_json(c).isNull())).alias("json_failures"))


def detail_rows(pages: DataFrame, key: str) -> DataFrame:
    """The primary record of every detail page; a blocked page has its state and the id of its url only."""
    v, s, d = F.try_parse_json("vehicle"), F.try_parse_json("dealer.seller"), F.col("dealer")
    here = lambda c: F.when(F.col("page_state") != "blocked", c)
    part = lambda n: F.trim(filled(F.regexp_extract(d["address"], ADDRESS, n)))
    own, by_url = filled(F.try_variant_get(v, "$.listing_id", "string")), filled(F.regexp_extract("url", UUID, 0))
    seller = lambda path: F.when(d.isNotNull(), filled(F.try_variant_get(s, path, "string")))
    unlisted = F.col("page_state") == "unlisted"
    out = {
        "listing_state": F.col("page_state"), "unlisted_title": F.when(unlisted, F.col("notice.title")), "unlisted_message": F.when(unlisted, F.when(F.col("notice").isNotNull(), F.col("notice.text")).otherwise(MARKER)),
        "listing_id": F.coalesce(here(own), by_url), "listing_id_source": F.when(here(own).isNotNull(), "initial-activity-data").when(by_url.isNotNull(), "url"), **{name: here(json_field(v, path, kind)) for name, (path, kind) in DETAIL_FIELDS.items()},
        "dealer_name": here(F.coalesce(d["name"], F.try_variant_get(v, "$.dealer_name", "string"))), "dealer_zip": here(F.coalesce(part(4), seller("$.zipcode"), F.try_variant_get(v, "$.dealer_zip", "string"))), "dealer_street": here(part(1)), "dealer_city": here(part(2)), "dealer_state": here(part(3)),
        "dealer_phone": here(seller("$.phoneNumber")), "dealer_website": here(F.substring_index(d["website"], "?", 1)), "dealer_url": here(d["link"]), "dealer_rating": here(d["rating"].try_cast("double")),
    }
    return pages.select(key, *[c.alias(name) for name, c in out.items()])


def carousel_id(c: Column) -> Column:
    return F.coalesce(c["save"], filled(F.regexp_extract(c["link"], UUID, 0)))


def carousel_rows(pages: DataFrame, key: str, site: str = "") -> DataFrame:
    """One row a carousel card with an id; blocked pages have none."""
    rows = pages.filter("page_state <> 'blocked'").select(key, F.explode("carousel").alias("c")).withColumn("listing_id", carousel_id(F.col("c"))).filter("listing_id is not null")
    got = lambda n: filled(F.regexp_extract("c.body", BODY, n))
    return rows.select(key, "listing_id", F.concat(F.lit(site), "c.link").alias("canonical_detail_url"), X.digits_to_int(F.col("c.price")).alias("price"), X.digits_to_int(F.col("c.footer")).alias("mileage"), F.col("c.body").alias("body"), got(1).alias("condition"), got(2).cast("int").alias("year"))


def carousel_counts(pages: DataFrame, key: str) -> DataFrame:
    """Per page: whether it has a carousel, its cards, those with an id, and what the cards lack."""
    cards = F.when((F.col("page_state") != "blocked") & F.col("carousel").isNotNull(), F.col("carousel")).otherwise(F.slice(F.coalesce("carousel", F.array()), 1, 0))
    named = F.filter(cards, lambda c: carousel_id(c).isNotNull())
    lacks = lambda what: F.size(F.filter(named, what))
    return pages.select(
        key, ((F.col("page_state") != "blocked") & F.col("carousel").isNotNull()).alias("carousel_found"), F.size(cards).alias("cards_found"), F.size(named).alias("cards_parsed"), (F.size(cards) - F.size(named)).alias("missing_listing_id"),
        lacks(lambda c: X.digits_to_int(c["price"]).isNull()).alias("missing_price"), lacks(lambda c: c["body"].isNull()).alias("missing_body"), lacks(lambda c: X.digits_to_int(c["footer"]).isNull()).alias("missing_mileage"),
    )


def routed(pages: DataFrame) -> DataFrame:
    """What becomes of a page by its state."""
    return pages.withColumn("route", F.when(F.col("page_state") == "blocked", "skip").when(F.col("page_state") == "unlisted", "tombstone").otherwise("observation"))
