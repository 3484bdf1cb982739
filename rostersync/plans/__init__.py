"""Pipeline operators: what a user of the package calls."""
