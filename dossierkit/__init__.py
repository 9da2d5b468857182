"""Entity profiles and searchable article collections out of messy, semi-structured sources."""
