"""All query modules, imported for their registrations."""

from changeflow.plans import changes, counts, reads, shapes, streams, writes  # noqa: F401
from changeflow.plans.registry import ORACLES, RUNS

__all__ = ["ORACLES", "RUNS"]
