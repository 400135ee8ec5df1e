"""Landed files, API payloads, snapshots, and one normaliser per source."""
