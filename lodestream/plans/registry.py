"""All registered queries of the core."""

from __future__ import annotations

from lodestream.operators import history, timestamps, units
from lodestream.plans import connectors, evidence, fields, matching, quality, reading, records, resolving, storing, streams, texts  # noqa: F401  (they register)
from lodestream.plans.instants_sql import P4_SQL, P6_SQL
from lodestream.plans.base import ORACLE, QUERIES, Query, query
from lodestream.plans.units_sql import P1_SQL

query("p1_found", P1_SQL)(units.p1_found)
query("p4_found", P4_SQL)(history.p4_found)
query("p6_found", P6_SQL)(timestamps.p6_found)
query("p6_zones")(timestamps.p6_zones)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
