"""Importing the plan modules fills the registry."""

from wayfare.plans import clusters, graph, ingest, jobs, requests, reviews, search, sinks, synthetic  # noqa: F401
from wayfare.registry import ORACLES, QUERIES  # noqa: F401
