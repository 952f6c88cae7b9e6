"""Column helpers shared by all plans: bands, exact numbers, text templates."""
