"""strata: a Spark-native toolkit for layered (bronze / silver / gold) analytics tables.

Data-quality tagging and quarantine, change-log application, versioned history,
surrogate keys, star-schema builders, governed views, reconciliation checks and
clustered layouts — all as DataFrame plans of built-in Spark operators.
"""

from .context import RunContext

__all__ = ["RunContext"]
__version__ = "0.1.0"
