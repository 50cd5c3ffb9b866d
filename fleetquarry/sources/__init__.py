"""Readers and sinks. Every schema is declared; nothing is inferred from the data."""
