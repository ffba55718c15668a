"""Writers and the incremental refresh."""
