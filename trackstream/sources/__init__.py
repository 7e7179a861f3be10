"""Sources: the events adapter, message envelopes, API snapshots, stream readers."""
