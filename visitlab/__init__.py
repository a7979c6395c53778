"""visitlab: session analytics for an online shop's visit log, written as
lazy Spark DataFrame plans.

Layout
------
``sources``    scans of the visit log, user and product tables; sinks.
``functions``  column expressions (time keys, text hygiene, packed records,
               rounding) that stay inside whole-stage codegen.
``operators``  the analyses: session profile, filters, length buckets,
               hourly sampling, category ranking, page flow.
``plans``      the named query registry and report jobs that chain operators.
``streaming``  the ad-click text stream, batch and Structured Streaming.
"""

from visitlab.params import TaskParams
from visitlab.session import get_spark

__version__ = "0.1.0"

__all__ = ["TaskParams", "get_spark", "__version__"]
