"""Transaction files, literal rows, staged tables and the derived test tables."""
