"""tidemark: behaviour analytics on Spark, batch and Structured Streaming.

* ``tidemark.sources``    driver tables, text loaders, Kafka builders
* ``tidemark.functions``  scalar column functions (exact time arithmetic, bitmap hash)
* ``tidemark.operators``  batch operators, DataFrame -> DataFrame
* ``tidemark.streaming``  stream forms, stateful processors, sinks
* ``tidemark.plans``      the registered queries, their parameters and DuckDB twins
* ``tidemark.session``    session set-up and sizing
"""

__version__ = "0.1.0"
