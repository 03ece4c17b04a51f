"""Small column and plan helpers shared by the operators."""
