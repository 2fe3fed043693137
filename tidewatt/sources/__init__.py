"""Reading inputs and earlier results."""
