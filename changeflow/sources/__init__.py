"""Reading tables: scans, range and shard splits, key chunks, snapshots."""
