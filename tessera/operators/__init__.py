"""DataFrame -> DataFrame operators: change data, quality, history, joins, star schema,
lineage and audit analysis."""
