"""One registered query per operator, over stand-ins derived from the test tables, and its oracle."""
