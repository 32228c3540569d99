"""Imports every module that registers queries."""

from genoweave.plans import (  # noqa: F401
    queries_blocks,
    queries_clustered,
    queries_drugs,
    queries_files,
    queries_groups,
    queries_shape,
    queries_sites,
)
from genoweave.plans.registry import ORACLES, QUERIES  # noqa: F401
