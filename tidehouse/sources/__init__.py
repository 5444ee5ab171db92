"""Reading topics, change logs and dictionaries."""
