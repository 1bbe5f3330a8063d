"""Listing pages: selectors, result cards, detail pages, carousels."""

import json

from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import pages

ID = "0f1e2d3c-aaaa-bbbb-cccc-0123456789ab"


def parse(spark, *texts):
    return pages.parsed(spark.createDataFrame(list(enumerate(texts)), "id long, html string").selectExpr("*", f"'https://x/vehicledetail/{ID}/' as url"), "id", "html", "url").cache()


def card(tag="fuse-card", **fields):
    return f"<{tag} data-vehicle-details='{json.dumps(fields)}'></{tag}>"


def test_selectors_in_one_pass():
    r = pages.read('<div class="dealer-card a"><img><div class="map-link"><span><a href="/1">one<b>two</b></a></span></div><a href="/2">x</a><br/></div><p class="map-link"><a>out</a></p><a href="/dealers/3">y</a>')
    assert [(x.inside, x.attrs["href"], x.text("")) for x in r.found["dealer_address"]] == [(0, "/1", "onetwo")]
    assert r.found["dealer_link"] == [] and len(r.found["link"]) == 3


def test_cards_and_counts(spark):
    page = card(listingId="A", price="$1,234", mileage=12.9, year="2024", isaContext="deal", seller={"zip": "12345"}, metadata={"page_number": "2 of 3"}) + card("spark-card", listingId=" B ", price="call", isaContext="", make=None) + card("div", listingId="C") + card(make="x") + card(listingId=" ") + "<fuse-card data-vehicle-details='{broken'></fuse-card><fuse-card></fuse-card><spark-card data-vehicle-details></spark-card>"
    p = parse(spark, page, None, "")
    assert rows(pages.card_rows(p, "id", "https://s"), "listing_id", "canonical_detail_url", "price", "mileage", "year", "isa_context", "seller_zip", "page_number") == [("A", "https://s/vehicledetail/A/", 1234, 12, 2024, "DEAL", "12345", 23), ("B", "https://s/vehicledetail/B/", None, None, None, None, None, None)]
    assert rows(pages.card_counts(p, "id")) == [(0, 6, 2, 2), (1, 0, 0, 0), (2, 0, 0, 0)]


def test_detail_states(spark):
    data = '<script id="initial-activity-data">{"listing_id": "L", "price": 20500.0, "dealer_name": "own", "dealer_zip": "1"}</script>'
    notice = '<spark-notification class="unlisted-notification" title=" No longer listed "> a <b>b</b></spark-notification>'
    p = parse(spark, data, "<title>Just a moment...</title>", notice + data, data + "<p>NO LONGER AVAILABLE</p>", "<p>no longer availableness</p>", None)
    assert rows(pages.detail_rows(p, "id"), "id", "listing_state", "unlisted_title", "unlisted_message", "listing_id", "listing_id_source", "price") == [
        (0, "active", None, None, "L", "initial-activity-data", 20500), (1, "blocked", None, None, ID, "url", None), (2, "unlisted", "No longer listed", "a b", "L", "initial-activity-data", 20500),
        (3, "unlisted", None, pages.MARKER, "L", "initial-activity-data", 20500), (4, "active", None, None, ID, "url", None), (5, "active", None, None, ID, "url", None),
    ]
    assert rows(pages.routed(p), "id", "route") == [(0, "observation"), (1, "skip"), (2, "tombstone"), (3, "tombstone"), (4, "observation"), (5, "observation")]


def test_dealer_card(spark):
    data = '<script id="initial-activity-data">{"dealer_name": "own", "dealer_zip": "1"}</script>'
    full = '<div class="dealer-card"><p><h3> The <i>Dealer</i></h3></p><div class="map-link"><a>12 Elm St Suite 4, San Antonio, TX 78701</a></div><div class="website"><a href="http://d.example/a?utm=1&x=2">w</a></div><a href="http://c/dealers/9">d</a><fuse-rating rating="4.7"></fuse-rating></div><script>{"seller" : {"phoneNumber": "555", "zipcode": "9"}}</script>'
    bare = '<div class="dealer-card"><fuse-rating rating="none"></fuse-rating><a>Elm</a></div><p x="{&quot;seller&quot;: {&quot;zipcode&quot;: &quot;9&quot;}}">'
    p = parse(spark, data + full, data + bare, data)
    names = ["dealer_name", "dealer_street", "dealer_city", "dealer_state", "dealer_zip", "dealer_phone", "dealer_website", "dealer_url", "dealer_rating"]
    assert rows(pages.detail_rows(p, "id"), "id", *names) == [
        (0, "TheDealer", "12 Elm St Suite 4", "San Antonio", "TX", "78701", "555", "http://d.example/a", "http://c/dealers/9", 4.7),
        (1, "own", None, None, None, "9", None, None, None, None), (2, "own", None, None, None, "1", None, None, None, None),
    ]


def test_carousel(spark):
    item = lambda save, body="", price="", foot="", href="": f'<fuse-card><fuse-save data-listing-id="{save}"></fuse-save>{href}<span class="price big">{price}</span><span class="body">{body}</span><span slot="footer">{foot}</span></fuse-card>'
    page = '<div class="listings-carousel x">' + item("A", "used 2021 Some Car", "$9,<b>999</b>", "12,000 mi.") + item("B", "CPO 2020 Van X") + item(" ", "New 20 Car", "$5", "", f'<a href="/vehicledetail/{ID}/">x</a>') + item("", "x") + "</div>" + item("D", "New 2020 Out")
    p = parse(spark, page, "<title>just a moment</title>" + page, "<div class='listings-carousel'></div>", None)
    assert rows(pages.carousel_rows(p, "id", "https://s"), "listing_id", "canonical_detail_url", "price", "mileage", "body", "condition", "year") == [
        (ID, f"https://s/vehicledetail/{ID}/", 5, None, "New 20 Car", None, None), ("A", None, 9999, 12000, "used 2021 Some Car", "used", 2021), ("B", None, None, None, "CPO 2020 Van X", "CPO", 2020),
    ]
    assert rows(pages.carousel_counts(p, "id")) == [(0, True, 4, 3, 1, 1, 0, 2), (1, False, 0, 0, 0, 0, 0, 0), (2, True, 0, 0, 0, 0, 0, 0), (3, False, 0, 0, 0, 0, 0, 0)]


def test_bare_references():
    page = '<title>a &amp;&lt;b&gt; & c&amp</title><script id="initial-activity-data">{"a": "b&c&amp"}</script><a href="?x=1&amp;y=2&z">u&#39;v</a>'
    assert pages.parts(page)["title"] == "a &<b> & c&"
    r = pages.read(page, bare=False)
    assert (r.text("title"), r.text("data"), r.attr("link", "href"), r.text("link")) == ("a &<b> & c&amp", '{"a": "b&c&amp"}', "?x=1&y=2&z", "u'v")


def test_small_rows_of_pages_go_to_many_tasks(spark):
    from tidemark.plans import boards
    from tidemark.plans.registry import Tables

    at = boards.listing_pages(Tables(spark, "/root/testdata/sf0.001")).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(at) == 4 and max(x["count"] for x in at) < 2 * sum(x["count"] for x in at) / 4
