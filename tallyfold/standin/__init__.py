"""Stand-in respondents from the test tables, and the queries registered on them."""
