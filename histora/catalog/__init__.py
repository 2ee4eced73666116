"""The registered queries: every operator on the test tables, with the SQL that gives the same rows."""
