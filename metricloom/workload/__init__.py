"""The registered queries over the test tables, each with the SQL it must agree with."""

from metricloom.workload import batches, documents, pulls, refreshes, reports, scalars, streams, tables
from metricloom.workload.registry import Query

QUERIES: dict[str, Query] = {
    name: query
    for module in (scalars, documents, tables, reports, streams, batches, refreshes, pulls)
    for name, query in module.QUERIES.items()
}
