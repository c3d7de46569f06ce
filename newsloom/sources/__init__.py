"""Reading stage tables and writing them."""
