"""Small builders for hand-made edge-case frames."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from parcelspark import schemas
from parcelspark.sources import seed
from parcelspark.sources.fixtures import RawTables


def facilities(spark, rows):
    return spark.createDataFrame(rows, schemas.FACILITIES)


def shipment(sid, origin=1, dest=2, weight="1.00", value="100.00", cost="10.00",
             created=datetime(2024, 1, 1), eta=date(2024, 1, 3), sender=1):
    return (sid, sender, origin, dest, Decimal(weight), Decimal(value), Decimal(cost), created, eta)


def shipments(spark, rows):
    return spark.createDataFrame(rows, schemas.SHIPMENTS)


def event(eid, sid, status, ts, facility=1, notes=None, source="events_x.json"):
    return (eid, sid, status, facility, ts, notes, source)


def events(spark, rows):
    return spark.createDataFrame(rows, schemas.TRACKING_EVENTS)


def weather(spark, rows):
    return spark.createDataFrame(rows, schemas.WEATHER)


DEFAULT_FACILITIES = [
    (1, "Hub A", "National Hub", "Berlin", 10),
    (2, "Branch B", "Local Branch", "Paris", 5),
]


def raw(spark, fac=None, ship=None, ev=None, wx=None) -> RawTables:
    return RawTables(
        facilities=facilities(spark, fac if fac is not None else DEFAULT_FACILITIES),
        shipments=shipments(spark, ship or []),
        tracking_events=events(spark, ev or []),
        weather=weather(spark, wx or []),
        status_codes=seed.status_codes(spark),
    )
