"""Tables, marts and reports composed from the operators."""
