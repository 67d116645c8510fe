"""Where jobs read from and write to."""
