"""Readers, table derivations from ERP-style inputs, and sinks."""
