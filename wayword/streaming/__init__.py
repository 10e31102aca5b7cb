"""The same transformations over a stream."""
