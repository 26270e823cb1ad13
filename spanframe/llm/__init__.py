"""Training-data operators at corpus scale.

Ten operators over a documents-like table, one module each, and the queries
that apply them to the driver tables (``queries.py``).  Nothing outside this
subpackage imports it.
"""
