"""Readers of bulk exports, reference tables and legislative relations, and sinks."""
