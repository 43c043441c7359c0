"""Training-data operators over the `documents`, `benchmark` and `conversations` tables.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; `queries` derives the registered
digest columns from the operators' real outputs.
"""
