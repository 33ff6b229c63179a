"""Readers. Every schema is given; raw text goes through the one rule for missing values."""
