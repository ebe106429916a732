"""The library's operators as named queries over the given star tables, with the SQL that must agree."""
