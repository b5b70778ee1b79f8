"""Registered queries over the given tables, each next to the SQL that must agree with it."""

from workload import counting, files, forum, heatmaps, listings, pipeline, scalars, social, streams  # noqa: F401  isort: skip
from workload import conformed  # noqa: F401  isort: skip, it reads the SQL of the others
from workload.base import ORACLES, QUERIES  # noqa: F401
