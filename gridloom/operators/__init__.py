"""Relational operators: DataFrame in, DataFrame out, nothing evaluated before an action."""
