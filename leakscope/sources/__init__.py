"""Where the data comes from and goes to."""
