"""Music-shaped inputs derived from the driver's tables, for queries and tests."""
