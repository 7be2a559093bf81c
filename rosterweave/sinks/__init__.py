"""Writers. Every folder they write is replaced."""
