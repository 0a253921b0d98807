"""Column-expression helpers: null rules (``rules``) and scalar functions
(``scalars``). Everything returns a ``Column``; nothing runs Python per row."""
