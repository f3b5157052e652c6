"""All registered queries: batch analytics, sources/sinks, ML, streaming.

Importing this module fills ``QUERIES`` / ``ORACLES``.
"""

from tarmac.plans import q_batch, q_io, q_ml, q_stream  # noqa: F401  (registration side effects)
from tarmac.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
