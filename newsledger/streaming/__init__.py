"""The same jobs on a stream."""
