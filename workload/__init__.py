"""The engine's queries over the provided star-schema tables, with their SQL counterparts."""
