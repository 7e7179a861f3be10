"""trackstream — PySpark-native analytics for moving-object telemetry.

Every operator is a DataFrame -> DataFrame function that takes column names as
keyword parameters (with the flight preset in :mod:`trackstream.schema` as the
default), performs no action and never looks up a session.  The same operators
run on batch tables and, where Structured Streaming allows, on streams.
"""

from trackstream.schema import FLIGHT, FLIGHT_SCHEMA, FlightColumns  # noqa: F401

__version__ = "0.1.0"
