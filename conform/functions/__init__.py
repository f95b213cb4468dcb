"""Column -> Column helpers; every one compiles to built-in expressions."""
