"""Writers, exports and partition-level table mutation."""
