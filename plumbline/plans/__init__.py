"""Domain recipes: silver, gold, dimensions, checks and reconciliation built from the operators."""
