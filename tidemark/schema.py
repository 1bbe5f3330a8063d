"""Schemas of the observation and event tables, and where tables lie."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_KINDS = {"l": T.LongType(), "i": T.IntegerType(), "h": T.ShortType(), "s": T.StringType(), "f": T.FloatType(), "t": T.TimestampType(), "b": T.BooleanType()}


def schema(text: str) -> T.StructType:
    """A schema from "name:kind" words; kinds are l i h s f t b."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (w.split(":") for w in text.split())])


OBSERVATIONS = schema(
    "artifact_id:l listing_id:s vin:s canonical_detail_url:s source:s listing_state:s fetched_at:t written_at:t price:i make:s model:s trim:s year:h mileage:i msrp:i "
    "stock_type:s fuel_type:s body_style:s dealer_name:s dealer_zip:s customer_id:s seller_id:s dealer_street:s dealer_city:s dealer_state:s dealer_phone:s dealer_website:s "
    "dealer_cars_com_url:s dealer_rating:f financing_type:s seller_zip:s seller_customer_id:s page_number:h position_on_page:h trid:s isa_context:s body:s condition:s obs_year:i obs_month:i obs_day:i"
)
EVENTS = {
    "price_observation_events": schema("event_id:l listing_id:s vin:s price:i make:s model:s artifact_id:l event_type:s source:s event_at:t"),
    "vin_to_listing_events": schema("event_id:l vin:s listing_id:s artifact_id:l event_type:s previous_listing_id:s event_at:t"),
    "blocked_cooldown_events": schema("event_id:l listing_id:s event_type:s num_of_attempts:i event_at:t"),
    "artifacts_queue_events": schema("event_id:l artifact_id:l status:s event_at:t minio_path:s artifact_type:s fetched_at:t listing_id:s run_id:s"),
    "detail_scrape_claim_events": schema("event_id:l listing_id:s run_id:s status:s stale_reason:s vin:s event_at:t"),
}

#: The business fields of a detail row, and of a row of any source, in the order they are hashed.
STATE_FIELDS = "listing_id vin17 price mileage msrp make model vehicle_trim model_year stock_type fuel_type body_style listing_state dealer_name dealer_zip dealer_city dealer_state customer_id".split()


@dataclass(frozen=True)
class Table:
    """A logical table: its path under a base folder, its time column, its partition columns."""

    path: str
    ts: str
    partitions: tuple[str, ...]
    schema: T.StructType | None = None
    key: tuple[str, ...] = ()


REGISTRY = {
    "observations": Table("silver_observations", "fetched_at", ("source", "obs_year", "obs_month"), OBSERVATIONS, ("source", "listing_id", "fetched_at", "artifact_id")),
    **{n: Table(n, "event_at", ("year", "month"), s, ("event_id",)) for n, s in EVENTS.items()},
}


def resolve(name: str, base: str) -> str:
    """The folder of a logical table under a base folder."""
    return f"{base.rstrip('/')}/{REGISTRY[name].path}"
