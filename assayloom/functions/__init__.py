"""Part of assayloom."""
