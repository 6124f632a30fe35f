"""Pipeline stages and report queries."""
