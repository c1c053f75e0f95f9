"""Reading and writing: captures, landing and transformed zones, objects, logs."""
