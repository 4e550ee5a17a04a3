"""Plans over the test tables: case-shaped inputs, registered queries, SQL checks."""
