"""tessera: a warehouse pipeline expressed as Spark DataFrame transformations.

Layers: ``sources`` (scans, staging, change feeds, fixtures), ``functions``
(column expressions), ``operators`` (change data, quality, history, joins,
star schema, lineage, audit), ``plans`` (the assembled warehouse and the
registered queries) and ``streaming`` (micro-batch variants).
"""

__all__ = ["session"]
