"""Writing results as CSV folders, single files and keyed records."""
