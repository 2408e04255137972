"""Sources: table registry and DDL, catalog scans, shaping of the driver's test tables."""
