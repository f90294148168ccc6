"""Structured Streaming variants of the demand, staffing and scoring operators."""
