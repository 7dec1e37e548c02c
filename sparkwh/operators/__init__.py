"""DataFrame operators: filters, joins, reports, loads, upkeep, query-log reports."""
