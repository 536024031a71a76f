"""Readers and tables: landing files, warehouse tables, seed dimensions."""
