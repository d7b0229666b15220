"""Part of tabulon; see README.md."""
