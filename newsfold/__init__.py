"""newsfold: multi-query search hits and page snapshots folded into ranked,
deduplicated event clusters, as Spark DataFrame jobs."""

__version__ = "0.1.0"
