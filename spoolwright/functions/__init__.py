"""Column expressions: text, paths, hashes, scores. All run inside the JVM unless the docstring says otherwise."""
