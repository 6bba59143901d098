"""Query plans over the driver tables: cohort report, vault loads, checks."""
