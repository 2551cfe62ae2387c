"""Training-data operators over `documents`, `pages`, `conversations`.

Nothing else in the package imports this subpackage; ``__spark_entry__.py``
adds its jobs only when it can be imported.
"""
