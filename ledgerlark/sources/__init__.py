"""Readers, writers and the binding of the given tables to the retail model."""
