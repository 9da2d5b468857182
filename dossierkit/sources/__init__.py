"""Reading landed data and writing results."""
