"""The library's operators over the test tables, each with an equivalent SQL query."""
