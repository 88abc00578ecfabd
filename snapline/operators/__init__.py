"""DataFrame -> DataFrame operators: envelope, dedup, neighbour lookup, change filters,
state, merge, audits, cadence, health, retention."""
