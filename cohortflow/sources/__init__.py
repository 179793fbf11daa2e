"""Reading and writing: JSON files, catalog tables, layout, snapshots, provenance."""
