"""Plan patterns shared by the operators: ordered chunks and skewed joins."""
