"""Registered queries by domain. Importing this package fills the catalogue."""

from terrawatt.plans.catalogue import (  # noqa: F401
    changes,
    detection,
    geospatial,
    graphs,
    joining,
    marts_queries,
    metering,
    nested_data,
    quality_checks,
    roundtrips,
    scalars,
    shares,
    streams_queries,
)
