"""Registered queries over the test tables, each with its equivalent SQL where one exists."""
