"""Column expressions: time, units, physics, curves."""
