"""DataFrame operators: envelopes and JSON, landing pages, quality counts, snapshots."""
