"""Named queries over the test tables, with the same result in SQL where SQL can state it."""
