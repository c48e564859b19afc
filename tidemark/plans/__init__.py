"""Registered queries over the driver's tables (``queries``), their parameters
(``params``) and independent DuckDB twins (``oracle``)."""
