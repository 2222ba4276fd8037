"""Readers and writers: wire JSON, seen ledger, training files."""
