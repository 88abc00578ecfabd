"""Query plans over the driver tables: derived feed views and the registered queries."""
