"""Build and analyse long entity-by-year panels on Spark."""
