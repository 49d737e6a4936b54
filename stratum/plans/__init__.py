"""Bronze -> silver -> gold runs built from the operators."""
