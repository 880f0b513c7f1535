"""Preparing, enriching and scoring tables of titles with PySpark."""
