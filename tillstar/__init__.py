"""tillstar: a Spark-native sales warehouse and analytics engine.

Raw order-line text is cleaned with column expressions, split into staging tables, loaded
into a star schema by set-based upserts, checked against its declared constraints, and
queried by reports, dashboard calculations, a question router, a profiler and a forecast.
"""

__version__ = "0.1.0"
