"""The same books, kept up to date by Structured Streaming."""
