"""The live path as Structured Streaming queries, on the same operators as the batch jobs."""
