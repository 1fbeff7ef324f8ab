"""Column -> Column helpers; every one stays inside Catalyst."""
