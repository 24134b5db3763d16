"""The operators bound to the test tables, each with the SQL it is compared with."""
