"""voltchurn: customer-retention analytics for a metered-utility business, on Spark.

Everything is a function ``DataFrame(s) -> DataFrame``; nothing runs until an
action.  Sub-packages:

- ``functions``  column expressions (tariff tiers, bins, guarded maths, text rules)
- ``sources``    readers, writers and the stand-in views over the driver tables
- ``operators``  reusable relational building blocks (dedup, fills, curves, tests)
- ``plans``      the layer builders (bronze, silver, gold), models, reports
- ``streaming``  incremental ingest and per-batch scoring
"""

KEY = "customer_id"

__all__ = ["KEY"]
