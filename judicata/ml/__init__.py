"""Delay model (ML-1..7), drift (ML-11) and priority index (ML-12)."""
