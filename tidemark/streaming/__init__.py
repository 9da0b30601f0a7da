"""Event-time windows on batches and streams, and tables kept up to date by a stream."""
