"""The audit log as a stream."""
