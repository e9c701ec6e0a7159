"""Column functions: names, parsing, dates and metrics. All run in the JVM unless a docstring says otherwise."""
