"""Operators for building training corpora: extraction, de-duplication, screening, scoring, mixing and sharding."""
