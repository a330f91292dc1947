"""Plans: the lazy warehouse, the named query registry, the rebuild job
and the independent SQL oracle used by the differential tests."""
