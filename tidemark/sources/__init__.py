"""Reading and writing shop tables."""
