"""Writes: landing, bronze and ledger appends, replacement by key."""
