"""Reusable DataFrame operators: latest row, running totals, numbering, maintenance, search."""
