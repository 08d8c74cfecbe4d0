"""All registered queries: importing the modules registers them."""

from platework.bindings import registrations, relational, runs, streams
from platework.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "registrations", "relational", "runs", "streams"]
