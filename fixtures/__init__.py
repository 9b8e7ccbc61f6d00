"""Catalogue-shaped inputs from the test tables, registered queries and their SQL oracles."""
