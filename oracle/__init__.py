"""DuckDB twins of the registered Spark queries (the correctness oracle).

Each twin is plain SQL over the driver's tables.  The stand-in views repeat
the column mapping of ``voltchurn.sources.standins``; every pipeline step is
then re-derived in SQL independently of the Spark code.
"""
