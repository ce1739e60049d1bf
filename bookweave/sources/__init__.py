"""Vendor tables in, snapshots and reports out."""
