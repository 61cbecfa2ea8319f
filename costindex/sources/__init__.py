"""Sources and sinks: registry, loaders, bookkeeping tables, state snapshots, fixtures."""
