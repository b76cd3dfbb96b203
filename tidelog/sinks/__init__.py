"""Writers for batches and streams."""
