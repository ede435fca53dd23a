"""Sources: landed JSON envelopes, bronze records, catalog reads and the
adapter from the driver's test tables."""
