"""Sources: the driver's tables (``tables``), text loaders (``text``), Kafka (``kafka``)."""

from tidemark.sources import kafka, tables, text

__all__ = ["kafka", "tables", "text"]
