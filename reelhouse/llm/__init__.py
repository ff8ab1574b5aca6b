"""Training-data operators: ten self-contained modules, their queries and SQL.

Nothing outside this subpackage imports it, apart from the guarded import in
``__spark_entry__.py``.
"""
