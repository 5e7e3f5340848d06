"""End-to-end plans, data sets derived from the driver tables, and the registered checks."""
