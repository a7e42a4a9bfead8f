"""Query plans over the driver tables: derived datasets and the registry."""
