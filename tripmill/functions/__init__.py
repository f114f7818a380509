"""Column functions: normalisation, time handling, exact rounding."""
