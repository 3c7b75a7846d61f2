"""Relational and pipeline operators written as DataFrame plans."""
