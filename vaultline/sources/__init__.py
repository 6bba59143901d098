"""Sources: change-event streams and snapshots, CSV files, vault tables."""
