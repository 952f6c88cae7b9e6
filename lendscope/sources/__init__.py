"""Inputs: declared schemas, stored tables, derived tables, feed and document files."""
