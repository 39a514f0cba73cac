"""parcelspark: shipment-tracking analytics on Spark (DataFrame API and
Structured Streaming).  See README.md for the layout and design."""

__version__ = "0.1.0"
