"""Part of quarry; see README.md."""
