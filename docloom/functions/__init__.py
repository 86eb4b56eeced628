"""Column-level building blocks: tokens, vocabularies, field rules."""
