"""Event-to-result operators, each a function from DataFrame to DataFrame."""
