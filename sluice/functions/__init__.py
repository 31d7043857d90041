"""Column functions and the fixed values they depend on."""
