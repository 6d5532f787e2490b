"""Named queries over the test tables, with the SQL they are checked against."""
