"""The hourly harvest as a stream."""
