"""DataFrame operators: conforming, cleaning, dedup, joins, merges, keys, calendar, fact, checks, audit."""
