"""Lendscope: corporate-lending credit-risk analytics on PySpark."""
