"""Table builders (silver, facts, marts), the table catalog, the layered
runs and the registered queries with their SQL oracles."""
