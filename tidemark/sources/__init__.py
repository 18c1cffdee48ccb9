"""Tables, files and adapters the operators read from and write to."""
