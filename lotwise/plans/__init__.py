"""Business plans: each function takes tables and parameters and returns a lazy DataFrame."""
