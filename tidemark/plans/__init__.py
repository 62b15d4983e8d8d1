"""Named queries over the standard tables."""

from tidemark.plans import events, relational, upkeep, streams  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES  # noqa: F401
