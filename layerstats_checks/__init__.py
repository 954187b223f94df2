"""The library's operators as queries over the given tables, with SQL oracles."""
