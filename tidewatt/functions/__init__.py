"""Column expressions shared by the three query faces."""
