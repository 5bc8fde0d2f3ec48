"""Query plans over the provided tables: adapters, registered queries, oracles."""
