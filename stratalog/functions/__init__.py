"""Part of stratalog."""
