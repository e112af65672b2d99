"""Writing tables: partitions, shards, routes, bulk text, quarantine."""
