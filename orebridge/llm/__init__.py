"""Training-data operators: one module per operator, queries in `queries`, SQL twins
in `oracle`. Nothing outside this subpackage imports it except the guarded entry point.

Row rules shared by every operator: a null text counts as the empty text; doc_id may be
null or repeated (every input row gets its own output row); other columns, whatever their
names, pass through untouched or are not read. Internal columns start with `__llm_`.
"""
