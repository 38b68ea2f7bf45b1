"""Reading, writing and keying of tables."""
