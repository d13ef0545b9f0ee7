"""Plain append targets."""
