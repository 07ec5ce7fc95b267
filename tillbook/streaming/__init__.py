"""Incremental landing of bank movements (the reconciliation itself stays batch)."""
