"""Importing this module registers every query."""

from callweave.queries import (  # noqa: F401
    aggregates,
    dashboards,
    exports,
    facts,
    joins,
    kpis,
    marts,
    nested,
    performance,
    process,
    projections,
    reshape,
    scalars,
    sources,
    streams,
    targets,
    timeaxis,
    upserts,
    windows,
)
