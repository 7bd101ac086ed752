"""Tables, namespaces and staged files."""
