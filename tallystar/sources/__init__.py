"""Tables, CSV snapshots and stream sources."""
