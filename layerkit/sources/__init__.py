"""Sources and sinks: test tables, staged CSV/JSON files, listings, external views, snapshots."""
