"""Writers, and the lines and fragments they write."""
