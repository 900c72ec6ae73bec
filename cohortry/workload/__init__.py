"""Registered queries over the star-schema tables, each with the SQL it must agree with."""
