"""Pipeline compositions, the query register and its SQL oracle."""
