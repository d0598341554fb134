"""Table-generic analytics operators.  Each returns a lazy DataFrame."""
