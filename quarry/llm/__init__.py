"""Training-data operators.  Nothing outside this subpackage imports it; see ``queries.py`` for the registered queries."""
