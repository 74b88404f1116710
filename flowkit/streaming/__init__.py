"""Event-time windows and stream runs."""
