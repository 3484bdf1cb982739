"""Column helpers: text normalisation and ordering."""
