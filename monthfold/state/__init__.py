"""Tables that hold state between runs."""
