"""Column expressions; all of them run in the JVM, on batch and streaming rows alike."""
