"""Millrace: web-sourced records cleaned, resolved and stored as set-oriented Spark operators."""
