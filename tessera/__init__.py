"""tessera — DataFrame operators for geo-tagged photo analytics, recommenders and a tuned
classifier, written against Spark's own planner (no Python UDFs)."""

__version__ = "0.1.0"
