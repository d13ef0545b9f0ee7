"""Version logs and change capture."""
