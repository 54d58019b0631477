"""Month expressions and numeric parsing."""
