"""Runnable pipelines over the test tables, each with the SQL that checks it."""

from strata.plans import (aggregations, audit, bikes, changes, clickstream, customers, ingest, loans, retail,  # noqa: F401
                          sensors, star_model, tables, telemetry, texts)
from strata.plans.registry import ORACLE, QUERIES  # noqa: F401
