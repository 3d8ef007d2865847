"""Registered queries: one per operator, with the SQL that checks it."""

from zonalis.queries import registry
from zonalis.queries import groups, models, ordered, scalars, space  # noqa: F401

ALL = registry.QUERIES
CHECKS = registry.CHECKS
