"""Column functions: dates, clinical values and recodes. Each returns a Column."""
