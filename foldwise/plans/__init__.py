"""Programs (train / predict / diagnose) and the registered query catalog."""
