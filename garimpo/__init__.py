"""garimpo: listing analytics as Spark jobs.

Stored pages and recorded API payloads become structured listings, which are
keyed, deduplicated, upserted and reported on. Everything is a DataFrame
transformation; callers own the session and decide when to run an action.
"""

__version__ = "0.1.0"
