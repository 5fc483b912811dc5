"""New snapshot files as a stream."""
