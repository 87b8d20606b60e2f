"""The registered queries and, for each, the SQL that checks it."""
