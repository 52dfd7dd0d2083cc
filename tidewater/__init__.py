"""tidewater: web analytics and price intelligence as PySpark DataFrame jobs.

Layout
------
sources/    table scans, page/catalog guards, keyed upsert, model sinks
functions/  column expressions: regex dialect helpers, text cleanup, rule tables, classifiers
operators/  relational building blocks (skew-safe ranking, anti/membership joins, html, json)
plans/      the four models (sessions, leads funnel, ROI, price plans) and the page ingest job
streaming/  the page ingest run as an incremental Structured Streaming job
harness/    stand-in inputs derived from the test tables, registered queries and oracle SQL
"""

__all__ = ["session"]
