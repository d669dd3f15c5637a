"""The 15-minute alert metrics as a Structured Streaming query."""
