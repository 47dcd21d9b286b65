"""Query catalogue: named plans over the driver tables, with SQL oracles."""
