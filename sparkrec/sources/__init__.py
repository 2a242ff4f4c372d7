"""Readers, writers and versioned table directories."""
